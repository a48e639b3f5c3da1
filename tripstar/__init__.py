"""tripstar: trip analytics on Spark DataFrames.

Monthly trip files are conformed to one table, turned into a star schema with
daily and hourly aggregate facts, and answered by marts and second-level
insights. Everything is a function from DataFrames to a DataFrame.
"""

from tripstar.session import configure, new_session
from tripstar.star import Star

__all__ = ["Star", "configure", "new_session"]
