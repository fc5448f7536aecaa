"""voltframe: Spark-native preparation and event-impact analysis of grid time series.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, windows, joins and aggregates. No time-series operator collects
rows to the driver or uses a Python UDF; some size their plan by a small job.
"""

__version__ = "0.1.0"
