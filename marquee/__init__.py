"""marquee: movie recommendation operators as Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame (ALS training
returns a Spark ML model).  See README.md for the operator list.
"""

__version__ = "0.1.0"
