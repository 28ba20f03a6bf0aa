"""Academic-record analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function meant for
``df.transform(...)``.  Nothing here reads the wall clock, and nothing pulls
rows of the input to the driver.
"""

__version__ = "0.1.0"
