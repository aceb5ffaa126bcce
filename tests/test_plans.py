"""Plan checks over every registered query: no Python in the data path, no
Cartesian product, and VARIANT path reads pushed into the Parquet scan."""

import contextlib
import io

import pytest

from conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    from lodestar.plans.catalog import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_no_python_no_cartesian(spark, name):
    from __spark_entry__ import queries
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_gold_reads_only_needed_paths(spark):
    from lodestar.plans import catalog
    df = catalog.q_projection_to_target(spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    # variant paths become typed struct fields of the scan, and the whole
    # projection is one global aggregation: no join, a single exchange
    assert "ReadSchema: struct<data:struct<" in text
    assert "Join" not in text and text.count("Exchange") <= 4


def test_partial_aggregation_before_shuffle(spark):
    from lodestar.plans import catalog
    plan = _plan(catalog.q_deployment_check(spark, SF_SMALL))
    # satellites are aggregated per launch before the join
    assert "partial_count" in plan


def test_top_k_is_not_a_global_sort(spark):
    from lodestar.plans import catalog
    plan = _plan(catalog.q_recent_runs(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_incremental_upsert_moves_only_the_batch(spark):
    from lodestar.plans import catalog
    plan = _plan(catalog.q_upsert_latest(spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


@pytest.mark.parametrize("name", ["silver_launches", "silver_satellites"])
def test_silver_is_one_codegen_stage_without_shuffle(spark, name):
    from lodestar.plans import catalog
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "Exchange" not in plan
    ops = [ln.strip(" +-:") for ln in plan.splitlines() if ln.strip(" +-:")]
    assert all(op.startswith("*(1)") for op in ops if not op.startswith("FileScan")), ops


def test_bucketed_keys_are_counted_in_place(spark):
    """Exact distinct counts and a batch's uniqueness on the bucketed history: at most
    the batch's keys are shuffled, never the stored side's."""
    from lodestar.plans import catalog
    plan = _plan(catalog.q_bucketed_key_counts(spark, SF_SMALL))
    assert "Bucketed: true" in plan and "hashpartitioning(id" not in plan
    plan = _plan(catalog.q_check_unique_batch(spark, SF_SMALL))
    stored = next(i for i, x in enumerate(plan.splitlines()) if "Bucketed: true" in x)
    assert "LeftSemi, BuildRight" in plan
    assert all("hashpartitioning(id" not in x for x in plan.splitlines()[:stored])

