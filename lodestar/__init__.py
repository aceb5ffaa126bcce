"""lodestar: a Spark-native medallion engine for JSON document collections.

Layers: bronze (landed documents, keyed upsert), silver (typed parsing with
quality flags and rule-based classification), gold (snapshot metrics and
run-rate projection towards a target).  Every operator is a function from
DataFrames to a DataFrame built of built-in Spark expressions, so Catalyst
plans the whole chain.
"""

from lodestar.session import configure, get_spark, shared_dir

__all__ = ["configure", "get_spark", "shared_dir"]
