"""tryline: match-statistics analytics on Spark (DataFrame operators)."""

__version__ = "0.1.0"
