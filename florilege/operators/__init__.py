"""DataFrame operators that work on any table: dates, nested records, skewed keys, quality profiles."""
