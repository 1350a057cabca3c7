"""quarry: a Spark-native engine for preparing large text corpora.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function
built from native Spark SQL expressions, joins, aggregations and windows.
Python runs inside tasks only where Spark has no built-in (Unicode NFD,
BPE encoding of distinct words, WARC record parsing).
"""

from quarry.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
