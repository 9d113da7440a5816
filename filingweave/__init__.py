"""Company-filing analytics on Spark: rosters, listings, archives and markup tables as DataFrames."""

from filingweave.session import tune

__all__ = ["tune"]
