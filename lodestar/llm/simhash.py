"""SimHash near-duplicates with pigeonring filtering.

A fingerprint bit is 1 when it is set in more than half of the XXH64 hashes of a
text's word shingles.  Two texts link when their fingerprints differ in at most
``distance`` bits.  The 64 bits are cut into ``distance + 1`` segments on a ring.
If the differences over all segments sum to at most ``distance``, some segment
starts a chain in which, for every length l, the first l segments together differ
in at most floor(l * distance / segments) bits.  Candidates are the fingerprints
that agree on the first ``chain`` segments of such a chain: each emits, for every
start, its chain with up to the budgeted number of set bits cleared (two chains
that differ within the budget meet where each clears the bits the other lacks).
The remaining chain lengths prune candidates before the full Hamming check.

Distribution: fingerprints are made map-side and reduced to distinct values (a
partial aggregation, so a hot group of copies is one row a task); candidate keys
are shuffled and sorted, and every key's run is linked by a breadth-first walk
that compares each reached fingerprint only with those not yet reached and emits
a spanning forest, never all pairs.  Components come from large-star/small-star
rounds over the links, checkpointed each round.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.components import components
from lodestar.llm.words import slices, texts
from lodestar.session import shared_dir

SHINGLE = 4
DISTANCE = 4
SEED = 42


def text_fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text (no words: 0; fewer than ``shingle``: the whole sequence)."""
    import xxhash
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size).tolist()
    last = end[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(start[:n], last)], dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):
        bits = np.unpackbits(h[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > n))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long.  A null text counts as empty.
    With ``digest`` also the SHA-256 of the text."""
    def run(batches):
        for part in slices(batches):
            made = [text_fingerprint(t, shingle) for t in texts(part.column("text")).to_pylist()]
            yield pa.record_batch([part.column("doc_id"), pa.array(np.array(made, dtype=np.uint64).view(np.int64)),
                                   *[part.column(c) for c in also]], names=["doc_id", "fp", *also])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    also = ["digest"] if digest else []
    if digest:
        rows = rows.withColumn("digest", _digest(F.col("text")))
    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} string" for c in also))


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    return list(zip(edges[:-1], edges[1:]))


def budgets(distance: int) -> list[int]:
    """Most differences allowed in the first 1, 2, ... segments of a chain."""
    m = distance + 1
    return [(k + 1) * distance // m for k in range(m)]


def chain_keys(fp: np.ndarray, distance: int, chain: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every budgeted chain variant of each fingerprint; the key's
    top bits hold the start segment."""
    bounds, most = segment_bounds(distance + 1), budgets(distance)
    rows, keys = [], []
    for i in range(len(bounds)):
        row = np.arange(len(fp))
        key, used = np.zeros(len(fp), np.uint64), np.zeros(len(fp), np.int64)
        for k in range(chain):
            lo, hi = bounds[(i + k) % len(bounds)]
            width = hi - lo
            piece = (fp[row] >> np.uint64(lo)) & np.uint64((1 << width) - 1)
            picked, pieces, spent = [np.arange(len(row))], [piece], [used]
            for c in range(1, most[k] + 1):
                for bits in combinations(range(width), c):
                    gone = np.uint64(sum(1 << b for b in bits))
                    ok = np.flatnonzero(((piece & gone) == gone) & (used + c <= most[k]))
                    picked.append(ok)
                    pieces.append(piece[ok] & ~gone)
                    spent.append(used[ok] + c)
            at = np.concatenate(picked)
            key = (key[at] << np.uint64(width)) | np.concatenate(pieces)
            row, used = row[at], np.concatenate(spent)
        rows.append(row)
        keys.append(key | np.uint64(i << key_bits(distance, chain)))
    return np.concatenate(rows), np.concatenate(keys)


def chain_ok(x: np.ndarray, start: int, distance: int) -> np.ndarray:
    """Which differences ``x`` keep every chain budget from segment ``start``
    (the last budget is the full Hamming check)."""
    bounds = segment_bounds(distance + 1)
    ok, total = np.ones(len(x), dtype=bool), np.zeros(len(x), dtype=np.int64)
    for k, most in enumerate(budgets(distance)):
        lo, hi = bounds[(start + k) % len(bounds)]
        total += np.bitwise_count((x >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1))
        ok &= total <= most
    return ok


def key_bits(distance: int, chain: int) -> int:
    """Bits of the widest chain; the start segment sits above them in a key."""
    return chain * max(hi - lo for lo, hi in segment_bounds(distance + 1))


def forest(fps: np.ndarray, start: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one key's fingerprints."""
    left, a, b = fps, [], []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            u = todo.pop()
            hit = chain_ok(left ^ u, start, distance)
            if hit.any():
                near = left[hit]
                left = left[~hit]
                a.append(near)
                b.append(np.full(len(near), u))
                todo.extend(near)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def run_links(key: np.ndarray, fp: np.ndarray, distance: int, top: int, pairs_to: int = 8):
    """Links within the runs of equal keys (sorted): all links of runs up to
    ``pairs_to`` fingerprints, spanning links of longer runs."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([edge, [len(key)]]))
    small = np.repeat((size > 1) & (size <= pairs_to), size)
    a, b = [], []
    for d in range(1, pairs_to):
        i = np.flatnonzero(small[:-d] & (key[d:] == key[:-d]))
        if not len(i):
            break
        starts = (key[i] >> np.uint64(top)).astype(np.int64)
        for s in np.unique(starts):
            at = i[starts == s]
            hit = at[chain_ok(fp[at] ^ fp[at + d], int(s), distance)]
            a.append(fp[hit])
            b.append(fp[hit + d])
    for at, n in zip(edge[size > pairs_to], size[size > pairs_to]):
        x, y = forest(np.unique(fp[at:at + n]), int(key[at] >> np.uint64(top)), distance)
        a.append(x)
        b.append(y)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, chain: int | None = None) -> DataFrame:
    """Links (u > v) that connect the distinct fingerprints ``fp`` within ``distance``
    bits.  ``chain`` is the number of segments that candidates share; by default
    two, and three once the fingerprints outnumber the two-segment keys (both find
    every link; a longer chain has fewer chance candidates and more variants)."""
    if chain is None:
        chain = 2 if distinct.count() <= 1 << key_bits(distance, 2) else 3
    if distance == 0:
        return distinct.sparkSession.createDataFrame([], "u long, v long")
    while key_bits(distance, chain) > 60 or chain > distance + 1:      # the start has to fit above
        chain -= 1
    top = key_bits(distance, chain)

    def explode(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                row, key = chain_keys(part, distance, chain)
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(part[row].view(np.int64))], names=["key", "fp"])

    def link(batches):
        held = None
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if held is not None:
                key, fp = np.concatenate([held[0], key]), np.concatenate([held[1], fp])
            if not len(key):
                continue
            cut = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1]))   # the last run may go on
            held = key[cut:], fp[cut:]
            if cut:
                yield out(*run_links(key[:cut], fp[:cut], distance, top))
        if held is not None:
            yield out(*run_links(*held, distance, top))

    def out(a, b):
        a, b = a.view(np.int64), b.view(np.int64)
        pair = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["u", "v"])

    keyed = distinct.select("fp").mapInArrow(explode, "key long, fp long")
    return (keyed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(link, "u long, v long").where("u > v").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; ``component_id`` is the smallest
    doc_id reachable over links of at most ``distance`` bits.

    Null or empty texts have fingerprint 0 and link like any other; repeated rows
    and repeated ids stay; rows with a null id take part with their text and get the
    component of their fingerprint (null when no id is in it)."""
    shared_dir(docs.sparkSession)
    made = fingerprints(docs, shingle, id_col, text_col).checkpoint()
    return made.join(_components_of(made, distance), "fp").select("doc_id", "fp", "component_id")


def _components_of(made: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints; ``root`` is the smallest
    fingerprint of the component, ``component_id`` its smallest doc_id."""
    nodes = made.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    linked = components(fingerprint_links(nodes, distance))
    root = nodes.join(linked, nodes["fp"] == linked["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    # stored, so the join below has an exchange on either side and a hot root is split
    least = root.groupBy("root").agg(F.min("rep").alias("component_id")).checkpoint()
    return root.join(least, "root").select("fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id (null
    ids last), of rows that repeat this id the smallest by text, then the other columns.

    Rows are judged by their own text, so different texts of one id are kept or dropped
    each; rows with neither an id nor a text pass unjudged."""
    shared_dir(docs.sparkSession)
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    blank = key.isNull() & text.isNull()
    judged = docs.where(~blank)
    made = fingerprints(judged, shingle, id_col, text_col, digest=True).checkpoint()
    # the (id, digest) pairs that may stay: those of each component's smallest id
    kept = (made.join(_components_of(made, distance), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("root").alias("_root")).distinct())
    first = [id_col, text_col] + [c for c in docs.columns if c not in (id_col, text_col)]
    one = (judged.join(kept, (_digest(text.cast("string")) == F.col("_digest")) & key.cast("long").eqNullSafe(F.col("_id")))
           .groupBy("_root").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in first])).alias("_row"))
           .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))
    return one.unionByName(docs.where(blank))
