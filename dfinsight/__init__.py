"""dfinsight: DataFrame-in, DataFrame-out cleaning, reporting, ranking and scaling operators.

Every operator is a pure function over Spark DataFrames built from Spark SQL expressions,
windows, joins and Structured Streaming; none collects data to the driver.
"""

__version__ = "0.1.0"
