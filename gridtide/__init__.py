"""gridtide: medallion analytics for metered energy time series on Spark.

Landing -> bronze -> silver -> gold, written as DataFrame transformations that
run unchanged on batch frames and on structured streams.
"""

__version__ = "0.1.0"
