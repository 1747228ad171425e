"""Flight punctuality analytics on Spark DataFrames.

Every operator takes a DataFrame (and column names) and returns a DataFrame,
so that Catalyst sees one declarative plan from the scan to the sink.
"""

__version__ = "0.1.0"
