"""DataFrame operators: quality, dedup, splits, terms, evaluation, training, reports."""
