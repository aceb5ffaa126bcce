"""Launch <-> satellite consistency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.rules import case_when

# fixed labels of the deployment status
MISSING_REFERENCE = "missing_launch_reference"
UNKNOWN_LAUNCH = "unknown_launch"
AS_ESTIMATED = "as_estimated"
BELOW_ESTIMATE = "below_estimate"
ABOVE_ESTIMATE = "above_estimate"


def deployment_check(launches: DataFrame, satellites: DataFrame) -> DataFrame:
    """Deployed vs estimated satellites per launch, plus satellites whose launch
    is unknown or missing.

    Satellites are first aggregated per launch_id (partial aggregation on the map
    side, so a launch carrying a third of all satellites costs one row per map
    task); the join then pairs two relations that are unique on launch_id, so no
    key is hot.  Spark picks broadcast vs sort-merge from measured sizes (AQE)."""
    per_launch = (satellites.where(F.col("satellite_id").isNotNull())
                  .groupBy("launch_id")
                  .agg(F.count(F.lit(1)).alias("deployed_satellites"),
                       F.count_if(F.col("is_active")).alias("active_satellites")))
    known = launches.select("launch_id", "mission_name", "estimated_satellite_count",
                            F.lit(True).alias("_known"))
    j = known.join(per_launch, "launch_id", "full_outer")
    deployed = F.coalesce(F.col("deployed_satellites"), F.lit(0)).cast("long")
    est = F.col("estimated_satellite_count").cast("long")
    status = case_when([
        (F.col("_known").isNull() & F.col("launch_id").isNull(), MISSING_REFERENCE),
        (F.col("_known").isNull(), UNKNOWN_LAUNCH),
        (deployed == est, AS_ESTIMATED),
        (deployed < est, BELOW_ESTIMATE),
    ], ABOVE_ESTIMATE)
    return j.select(
        "launch_id", "mission_name", "estimated_satellite_count",
        deployed.alias("deployed_satellites"),
        F.coalesce(F.col("active_satellites"), F.lit(0)).cast("long").alias("active_satellites"),
        status.alias("deployment_status"),
    )
