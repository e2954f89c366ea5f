"""riskloom — credit-risk analytics as Spark DataFrame operators.

Every operator is DataFrame in, DataFrame out, built from Spark SQL
expressions, aggregations, windows and joins, or from Spark ML.
"""

from riskloom.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
