"""Smaller document jobs: quote series, order-value totals, map totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.json import jmap, jnum, jtext, map_sum


def quote_series(replies: DataFrame, reply_col: str = "reply", element: str = "chart.result[0]") -> DataFrame:
    """Pick ``chart.result[0]`` from landed market-data replies: its JSON text plus
    the symbol.  Pure projection, no shuffle."""
    v = F.parse_json(F.col(reply_col))
    return replies.select(
        "*",
        jtext(v, element + ".meta.symbol").alias("symbol"),
        jtext(v, element).alias("series_json"),
        jnum(v, element + ".close", "double").alias("close"),
    ).drop(reply_col)


def map_totals(df: DataFrame, map_col: str) -> DataFrame:
    """Per row: the total of a flat JSON object's values."""
    return df.withColumn("map_total", map_sum(jmap(F.col(map_col))))


def order_totals(maps: DataFrame, map_col: str = "order_map", by: str | None = None) -> DataFrame:
    """Total order value (sum of all map values), formatted to 2 decimals.
    Per-row totals are summed with partial aggregation; ``by`` groups."""
    t = map_totals(maps, map_col)
    agg = [F.sum("map_total").alias("total_order_value")]
    out = t.groupBy(by).agg(*agg) if by else t.agg(*agg)
    return out.withColumn("total_order_value_text", F.col("total_order_value").cast("decimal(38,2)").cast("string"))
