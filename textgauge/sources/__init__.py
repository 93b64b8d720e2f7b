"""Table readers, schema enforcement, sinks and scratch locations."""
