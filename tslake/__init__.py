"""tslake: incremental time-series lakehouse operators on PySpark.

Every operator is a function from DataFrames to DataFrames and covers all
series in one plan. Only modules under ``sources`` and ``operators.publish``
perform writes.
"""

__version__ = "0.1.0"
