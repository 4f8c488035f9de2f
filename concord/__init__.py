"""concord: Spark-native table reconciliation, change loading and time-series shaping.

Every operator is a pure ``DataFrame -> DataFrame`` function (or returns a small
tuple of DataFrames).  Nothing collects row data to the driver; only metric rows
or metadata (column lists) ever leave the executors.
"""

__version__ = "0.1.0"
