import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="lodestar-test-ckpt-")
    s = get_spark("local[4]", app="lodestar-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def docs(spark):
    """Build a bronze-like DataFrame (id, data VARIANT, extracted_at, source_system,
    created_at) from Python dicts, serialised exactly as given (absent keys stay
    absent, None becomes JSON null)."""
    from pyspark.sql import functions as F

    def make(objs, extracted_at="2025-07-30 00:00:00"):
        rows = [(json.dumps(o),) for o in objs]
        df = spark.createDataFrame(rows, "j string")
        return df.select(
            F.get_json_object("j", "$.id").alias("id"),
            F.parse_json("j").alias("data"),
            F.lit(extracted_at).cast("timestamp_ntz").alias("extracted_at"),
            F.lit("api_v4").alias("source_system"),
            F.lit(extracted_at).cast("timestamp_ntz").alias("created_at"))
    return make
