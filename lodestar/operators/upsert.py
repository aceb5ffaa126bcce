"""Keyed upsert of document versions (bronze sink) without a MERGE-capable table.

The reference semantics: insert new keys; for an existing key replace only the
update columns (``data``, ``extracted_at``) and keep the rest (``source_system``,
``created_at``) from the first insert; statements run in order, so a key repeated
inside one batch resolves to its *last* row.

Spark forms:

* ``current_state(log)``: an aggregation over an append-only log,
  ``max_by(update cols, order)`` and ``min_by(keep cols, order)`` per key.  Both
  are declarative aggregates, so the map side pre-aggregates each partition
  before the shuffle on the key: a key holding a third of all rows still leaves
  every map task as one row, and no reducer sees the hot key's full history.
* ``upsert(state, batch)``: the same over state + batch (one shuffle of both).
* ``merge_state(state, batch)``: the batch reduced per key, then a full outer
  join with the state.  With the state stored bucketed by key, only the batch is
  shuffled and the merged state is written back bucket by bucket from the join tasks.
* ``overlay(state, batch)`` (the stored state of ``sources.state``): the same, without
  the state's documents in a join's build side, a sort or a shuffle.  State rows pass
  a filter by the batch's keys and stream through; the batch's rows look up only the
  narrow keep columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPDATE_COLS = ("data", "extracted_at")
KEEP_COLS = ("source_system", "created_at")
ORDER_COL = "_order"


def _order(order: Sequence[str] | str | Column) -> Column:
    if isinstance(order, Column):
        return order
    if isinstance(order, str):
        return F.col(order)
    return F.struct(*[F.col(c) for c in order])


def current_state(log: DataFrame, key: str = "id", order: Sequence[str] | str | Column = ("batch", "pos"),
                  update_cols: Sequence[str] = UPDATE_COLS, keep_cols: Sequence[str] = KEEP_COLS,
                  keep_order: bool = False) -> DataFrame:
    """Latest state per key of an append-only log of versions.

    ``order`` orders the writes (for example ``(batch, pos)``); it must be free of
    ties per key for a deterministic result.  With ``keep_order`` the winning
    order value is kept as ``_order`` so the state can take further upserts."""
    o = _order(order)
    # a row without a key cannot be stored (landing reports it): it takes no part
    log = log.where((key if isinstance(key, Column) else F.col(key)).isNotNull())
    agg = [F.max_by(F.struct(*update_cols), o).alias("_u"),
           F.min_by(F.struct(*keep_cols), o).alias("_k")]
    if keep_order:
        agg.append(F.max(o).alias(ORDER_COL))
    state = log.groupBy(key).agg(*agg)
    cols = [key] + [F.col(f"_u.{c}").alias(c) for c in update_cols] + \
        [F.col(f"_k.{c}").alias(c) for c in keep_cols]
    if keep_order:
        cols.append(ORDER_COL)
    return state.select(*cols)


def upsert(state: DataFrame | None, batch: DataFrame, key: str = "id",
           order: Sequence[str] | str | Column = ("batch", "pos"),
           update_cols: Sequence[str] = UPDATE_COLS, keep_cols: Sequence[str] = KEEP_COLS) -> DataFrame:
    """Apply one batch to a state produced by ``current_state(..., keep_order=True)``
    (or by a previous ``upsert``).  State rows rank before every batch row, so a
    batch row always replaces the update columns and never the keep columns.

    Cost is one shuffle of state + batch on the key, not of the whole history."""
    cols = [key, *update_cols, *keep_cols]
    b = batch.select(*cols, F.struct(F.lit(1).alias("src"), _order(order).alias("o")).alias(ORDER_COL))
    if state is None:
        merged = b
    else:
        s = state.select(*cols, F.struct(F.lit(0).alias("src"), F.col(ORDER_COL).alias("o")).alias(ORDER_COL))
        merged = s.unionByName(b)
    out = current_state(merged, key, ORDER_COL, update_cols, keep_cols, keep_order=True)
    return out.withColumn(ORDER_COL, F.col(f"{ORDER_COL}.o"))


def _order_text(df: DataFrame) -> Column:
    c = F.col(ORDER_COL)
    if isinstance(df.schema[ORDER_COL].dataType, T.StringType):
        return c
    return F.to_json(F.struct(c.alias("o")))


def merge_state(state: DataFrame | None, batch: DataFrame, key: str = "id",
                order: Sequence[str] | str | Column = ("batch", "pos"),
                update_cols: Sequence[str] = UPDATE_COLS, keep_cols: Sequence[str] = KEEP_COLS) -> DataFrame:
    """Apply one batch to a state as a join: the same result as ``upsert``.

    The batch is first reduced to one row per key (partial aggregation absorbs
    hot keys), then full-outer joined with the state on the key: batch values win
    for the update columns, state values for the keep columns.  Both sides are
    unique on the key, so the join has no hot key.  When the state is stored
    bucketed by the key (``lodestar.sources.layers.bucketed``), Spark shuffles
    only the batch side and the state is read in place: a daily batch costs a
    shuffle of the batch, not of the whole state."""
    b = current_state(batch.withColumn(ORDER_COL, _order(order)), key, ORDER_COL,
                      update_cols, keep_cols, keep_order=True)
    # the winning write order is kept as JSON text: orders of different batches
    # are never compared (the batch always wins), and text keeps the state's
    # schema independent of the landing layout that produced each batch
    b = b.withColumn(ORDER_COL, _order_text(b))
    if state is None:
        return b
    s = state.select(key, *update_cols, *keep_cols, _order_text(state).alias(ORDER_COL))
    j = s.alias("s").join(b.alias("b"), key, "full_outer")
    in_b = F.col(f"b.{ORDER_COL}").isNotNull()
    in_s = F.col(f"s.{ORDER_COL}").isNotNull()
    cols = [F.col(key)]
    cols += [F.when(in_b, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in update_cols]
    cols += [F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in keep_cols]
    cols.append(F.when(in_b, F.col(f"b.{ORDER_COL}")).otherwise(F.col(f"s.{ORDER_COL}")).alias(ORDER_COL))
    return j.select(*cols)


def overlay(state: DataFrame, batch: DataFrame, key: str = "id", order: Sequence[str] | str | Column = ("batch", "pos"),
            update_cols: Sequence[str] = UPDATE_COLS, keep_cols: Sequence[str] = KEEP_COLS) -> DataFrame:
    """Apply one batch to a state bucketed by ``key``: the same result as ``merge_state``.

    Rows of the state that the batch does not touch probe a hash set of the batch's
    keys (anti join, built from the shuffled keys of the same bucket) and go straight
    on: their documents are neither shuffled, sorted nor held.  For the batch's own
    rows, the keep columns of the keys that exist are found by a semi join of the
    state's narrow columns with the same keys, so what is joined afterwards has the
    size of the batch."""
    b = current_state(batch.withColumn(ORDER_COL, _order(order)), key, ORDER_COL, update_cols, keep_cols, keep_order=True)
    b = b.withColumn(ORDER_COL, _order_text(b))
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    # hash joins build from the keys: the state's side is only streamed
    untouched = (state.select(key, *update_cols, *keep_cols, _order_text(state).alias(ORDER_COL))
                 .join(keys.hint("shuffle_hash"), key, "left_anti"))
    known = (state.select(key, F.struct(*keep_cols).alias("_k"))
             .join(keys.hint("shuffle_hash"), key, "left_semi"))
    touched = b.join(known.hint("shuffle_hash"), key, "left").select(
        key, *update_cols, *[F.when(F.col("_k").isNotNull(), F.col(f"_k.{c}")).otherwise(F.col(c)).alias(c) for c in keep_cols], ORDER_COL)
    return untouched.unionByName(touched)


def upsert_stats(state: DataFrame | None, batch: DataFrame, key: str = "id") -> DataFrame:
    """One row (batch_rows, inserted, updated) for applying ``batch`` to ``state``.

    A row-at-a-time upsert counts an insert for the first row of each new key and
    an update for every other row, so inserted = distinct batch keys absent from the
    state, updated = batch rows - inserted.  Rows without a key are not counted.

    Plan: rows per batch key (partial aggregation, so a hot key is one row per
    task), a left join of those keys with the state's keys (unique by
    construction; with the state bucketed by key only the batch side moves), and
    one global fold."""
    per_key = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    is_new = F.lit(True)
    if state is not None:
        known = state.select(F.col(key).alias("_known"))
        per_key = per_key.join(known, per_key[key] == known["_known"], "left")
        is_new = is_new & F.col("_known").isNull()
    folded = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("batch_rows"),
                         F.count_if(is_new).alias("inserted"))
    return folded.select("batch_rows", "inserted", (F.col("batch_rows") - F.col("inserted")).alias("updated"))
