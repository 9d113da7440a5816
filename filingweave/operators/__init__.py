"""DataFrame operators. Column names are arguments, so every operator runs on any table."""
