"""Column expressions: hashing, text statistics, text cleaning, metric ratios."""
