"""Property test: every upsert form equals a plain sequential model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.operators.upsert import current_state, merge_state, upsert

ROWS = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", "c", "d"]),
                          st.integers(0, 9)), min_size=1, max_size=40)


def _model(rows, split):
    """Row-at-a-time upsert: last write wins, the first insert keeps created_at."""
    state = {}
    for i, (k, v) in enumerate(rows):
        batch = 0 if i < split else 1
        first = state.get(k, (None, None, (batch, i)))[2]
        state[k] = (f"{v}", batch, first)
    return {k: (val, b, fb) for k, (val, b, (fb, _)) in state.items()}


def _frame(spark, rows, split):
    data = [(k, str(v), 0 if i < split else 1, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, v string, batch int, pos int")
    return df.select("id", F.parse_json(F.to_json(F.struct("v"))).alias("data"),
                     F.col("batch").cast("long").alias("extracted_at"),
                     F.lit("s").alias("source_system"),
                     F.col("batch").cast("long").alias("created_at"), "batch", "pos")


def _view(df):
    return {r["id"]: (r["v"], r["extracted_at"], r["created_at"])
            for r in df.select("id", "extracted_at", "created_at",
                               F.variant_get("data", "$.v", "string").alias("v")).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, cut=st.floats(0, 1))
def test_upsert_forms_agree_with_sequential_model(spark, rows, cut):
    split = int(len(rows) * cut)
    want = _model(rows, split)
    log = _frame(spark, rows, split).repartition(3)
    b0, b1 = log.where("batch = 0"), log.where("batch = 1")
    assert _view(current_state(log, order=("batch", "pos"))) == want
    assert _view(upsert(upsert(None, b0, order="pos"), b1, order="pos")) == want
    assert _view(merge_state(merge_state(None, b0, order="pos"), b1, order="pos")) == want


def test_exact_ratio_helpers_match_fraction_arithmetic(spark):
    """ceil_ratio / round_ratio against exact rational arithmetic on many random
    pairs (negatives, exact ties such as x.5 and x.x5, large values)."""
    import math
    import random
    from decimal import Decimal
    from fractions import Fraction

    from lodestar.functions.exprs import ceil_ratio, round_ratio
    rnd = random.Random(7)
    pairs = [(rnd.randint(-10**12, 10**12), rnd.choice([1, 2, 3, 7, 8, 12, 40, 48, 62, 3600, 3662, 10**9 + 7]))
             for _ in range(400)]
    pairs += [(5, 2), (-5, 2), (1, 8), (-1, 8), (125, 1000), (-125, 1000), (0, 5), (38732 * 62, 3662)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", ceil_ratio("a", "b").alias("c"), round_ratio("a", "b", 0).alias("r0"),
                    round_ratio("a", "b", 1).alias("r1"), round_ratio("a", "b", 2).alias("r2")).collect()

    def half_away(q: Fraction, digits: int) -> Decimal:
        scaled = abs(q) * 10 ** digits
        n = math.floor(scaled + Fraction(1, 2))
        return (Decimal(n if q >= 0 else -n)).scaleb(-digits)

    for r in got:
        q = Fraction(r["a"], r["b"])
        assert r["c"] == math.ceil(q), (r["a"], r["b"])
        for digits, col in ((0, "r0"), (1, "r1"), (2, "r2")):
            assert r[col] == half_away(q, digits), (r["a"], r["b"], digits, r[col])
