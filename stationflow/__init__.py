"""DataFrame operators over station time series on Spark."""
