"""meterlake: usage, billing and support analytics for cloud customers, on Spark.

Every transform takes DataFrames and returns DataFrames; nothing but single-row
scalars (a date, a row count) ever reaches the driver.
"""

__version__ = "0.1.0"
