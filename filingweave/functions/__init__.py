"""Column functions: everything here is built-in expressions, usable in select, where and agg."""
