"""DataFrame operators: cleaning, quality, ranks, relational helpers, tests, models."""
