"""Steps that stored documents pass through: once a file, a delta or a bucket, not once more a row."""

from pyspark.sql import functions as F

from lodestar.plans import catalog
from lodestar.sources.documents import natural, read_documents
from lodestar.sources.layers import buckets_for, bucketed, writing
from lodestar.sources.state import append_batch, read_state


def plan(df):
    return df._jdf.queryExecution().toString()


def rows(spark, n=20):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select((F.col("id") % 7).cast("string").alias("id"), F.parse_json(F.to_json(F.struct("id"))).alias("data"),
                                 at.alias("extracted_at"), F.lit("s").alias("source_system"), at.alias("created_at"), F.col("id").alias("pos"))


def test_a_single_delta_is_not_merged_again(spark, tmp_path):
    append_batch(spark, "one", rows(spark), root=str(tmp_path))
    state = read_state(spark, "one", root=str(tmp_path))
    assert "Aggregate" not in plan(state) and "Exchange" not in plan(state)
    assert {r["id"]: r["d"] for r in state.select("id", F.to_json("data").alias("d")).collect()} == \
        {str(k): '{"id":%d}' % max(i for i in range(20) if i % 7 == k) for k in range(7)}


def test_file_order_is_made_once_a_file(spark, tmp_path):
    for k in (2, 10):
        spark.range(k, k + 3).selectExpr("concat('{\"id\":\"', id, '\"}') AS value").coalesce(1).write.text(f"{tmp_path}/part={k}")
    docs = read_documents(spark, str(tmp_path))
    assert "BroadcastHashJoin" in plan(docs)
    got = docs.select("id", (F.col("pos.file") == natural(F.col("file"))).alias("same")).collect()
    assert len(got) == 6 and all(r["same"] for r in got)


def test_bucketed_rows_are_written_unsorted_and_settings_return(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = bucketed(spark, "bronze", "b", "k", "id", 9, lambda: rows(spark).groupBy("id").agg(F.count("*").alias("n")), root=str(tmp_path), prepartitioned=True)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert {r["id"]: r["n"] for r in out.collect()} == {str(k): len(range(k, 20, 7)) for k in range(7)}
    with writing(spark, 5):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_buckets_follow_the_documents(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert buckets_for(spark, 10) == least
    assert buckets_for(spark, 500_000 * 1000) == max(least, 1000)


def test_landed_slices_hold_the_log_in_write_order(spark, tmp_path):
    at = "timestamp'%s'"
    items = " UNION ALL ".join(
        f"SELECT CAST({k % 5} AS BIGINT) l_orderkey, CAST({k} AS BIGINT) l_partkey, CAST(3 AS BIGINT) l_suppkey, 1 l_linenumber, 2.0D l_quantity, CAST({100 - k} AS DOUBLE) l_extendedprice, "
        f"0.0D l_discount, 0.1D l_tax, 'A' l_returnflag, 'F' l_linestatus, {at % ('199%d-0%d-01 00:00:00' % (4 + k % 6, 1 + k % 9))} l_shipdate" for k in range(30))
    spark.sql(items).write.parquet(f"{tmp_path}/lineitem.parquet")
    log = catalog.satellite_log(spark, str(tmp_path)).orderBy("batch", "pos").select(F.col("data").cast("string").alias("v")).collect()
    got = []
    for k in range(3):
        folder = catalog.landed_satellite_slice(spark, str(tmp_path), k)
        part = spark.read.text(folder).select("value", natural(F.col("_metadata.file_path")).alias("f"), F.monotonically_increasing_id().alias("r"))
        got += [r["value"] for r in part.orderBy("f", "r").collect()]
    assert got == [r["v"] for r in log]
