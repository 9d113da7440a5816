"""Operators for preparing training text at scale, each registered as a query ``opN_<name>``."""
