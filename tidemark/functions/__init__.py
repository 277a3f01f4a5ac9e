"""Column helpers, skew-proof ordered functions and exact quantiles."""
