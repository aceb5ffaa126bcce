"""Ranked lexical search over per-term postings in geometric blocks.

One map over the documents stores each one's sparse vector over the queries' terms
(term, occurrences, length) and, once a task, the statistics.  A second map takes the
stored vectors in shards of bounded size and searches each shard's inverted index:

* the posting list of every term is cut into blocks of similar documents: centres are
  drawn from the list and every document joins the nearest by angle, in a random
  projection of the weighted vectors;
* a block's summary is the coordinatewise maximum of its documents' term scores, so
  a query's sum over the summary bounds the score of everything in the block;
* a query visits the lists of its terms, rarest first; a block is skipped only if its
  exact bound is below the query's k-th best score so far (equal bounds are scored,
  because ties are broken by id), and the documents of the others are scored exactly,
  once each, from the shard's vectors; the summary of a whole list (its one maximum)
  bounds what the lists still to come can add up to, and ends a query the same way.

The k-th best scores carry over from shard to shard of a task, so later shards skip
most blocks.  A task emits its k best documents of each query; these are ranked by
Spark.  Nothing of a posting list is shuffled, however many documents hold the term.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.totals import pack, total, unpack
from lodestar.llm.words import LOWER, buffers, hash_spans, slices, texts
from lodestar.session import shared_dir

#: Queries are taken in blocks of about this many (by hash of the row), one after another.
BLOCK_ITEMS = 1024
#: Cells (documents x terms) of a shard's score matrix: 32 MB.
SHARD_CELLS = 1 << 22
#: Postings of a block on average; lists up to this long are one block.
BLOCK_POSTINGS = 32
#: Dimensions of the projection in which documents are compared.
SKETCH = 16

TERM = np.zeros(256, dtype=bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True


def find_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every term in order, first term of each text and the end):
    maximal runs of ASCII letters, digits and everything beyond ASCII; A-Z lowered."""
    raw, off = buffers(column)
    raw = LOWER[raw]
    solid = TERM[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[off] = True
    before = np.concatenate([[False], solid[:-1]]) & ~edge[:-1] if len(raw) else solid
    start = np.flatnonzero(solid & ~before)
    after = np.concatenate([solid[1:], [False]]) & ~edge[1:] if len(raw) else solid
    end = np.flatnonzero(solid & ~after) + 1
    return hash_spans(raw, start, end), np.searchsorted(start, off)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def discounts(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document: 10 + (90 * length * documents) div terms."""
    if not len(length):
        return np.zeros(0, np.int64)
    if int(length.max()) * 90 * n_docs < 2**62:
        return 10 + (90 * length * n_docs) // max(n_terms, 1)
    return np.array([10 + 90 * int(n) * n_docs // max(n_terms, 1) for n in length], dtype=np.int64)


class Shard:
    """Documents of a shard (rows of term scores) and the blocks of their postings."""

    def __init__(self, scores: np.ndarray, projection: np.ndarray):
        self.scores = scores
        doc, term = np.nonzero(scores)
        self.first_of_doc = np.searchsorted(doc, np.arange(len(scores) + 1))
        self.term_of, self.value_of = term, scores[doc, term]
        by_term = np.argsort(term, kind="stable")
        self.postings, self.first = doc[by_term], np.searchsorted(term[by_term], np.arange(scores.shape[1] + 1))
        sketch = scores @ projection
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents by block, first of each block and the end, summaries)."""
        docs = self.postings[self.first[term]:self.first[term + 1]]
        many = -(-len(docs) // BLOCK_POSTINGS)
        block = np.zeros(len(docs), np.int64)
        if many > 1:
            centres = docs[np.arange(many) * len(docs) // many]
            _, block = np.unique((self.sketch[docs] @ self.sketch[centres].T).argmax(axis=1), return_inverse=True)
        order = np.argsort(block, kind="stable")
        docs, block = docs[order], block[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(docs)]])
        # coordinatewise maxima over the block's documents
        size = self.first_of_doc[docs + 1] - self.first_of_doc[docs]
        at = np.repeat(self.first_of_doc[docs] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        summary = np.zeros((len(first) - 1, self.scores.shape[1]))
        np.maximum.at(summary, (np.repeat(block, size), self.term_of[at]), self.value_of[at])
        return docs, first, summary

    def search(self, members: np.ndarray, order: np.ndarray, queries: list[np.ndarray], floor: np.ndarray, k: int):
        """(query, document, score) of all that may be among the k best; ``floor`` holds
        each query's k-th best score so far and rises.  ``members`` (terms x queries)
        marks a query's terms, ``order`` is the order in which lists are visited."""
        seen = np.zeros((len(queries), len(self.scores)), dtype=bool)
        best = [np.zeros(0)] * len(queries)
        found = []
        scored = 0
        # a document in none of the lists visited so far scores at most the sum of the
        # maxima of a query's lists to come
        cap = self.scores.max(axis=0, initial=0)
        left = cap @ members
        for term in order:
            if self.first[term] == self.first[term + 1]:
                continue
            asking = np.flatnonzero(members[term])
            here = left[asking]
            left[asking] -= cap[term]
            asking = asking[here >= floor[asking]]
            if not len(asking):
                continue
            docs, first, summary = self.blocks(term)
            size = np.diff(first)
            for q in asking:
                # sums of whole numbers below 2^53 are exact
                bound = summary[:, queries[q]].sum(axis=1)
                some = docs[np.repeat((bound >= floor[q]) & (bound > 0), size)]
                some = some[~seen[q, some]]
                if not len(some):
                    continue
                seen[q, some] = True
                scored += len(some)
                score = self.scores[np.ix_(some, queries[q])].sum(axis=1)
                good = (score >= floor[q]) & (score > 0)
                some, score = some[good], score[good]
                if not len(some):
                    continue
                found.append((np.full(len(some), q), some, score))
                top = np.concatenate([best[q], score])
                best[q] = np.sort(top)[-k:]
                if len(best[q]) == k:
                    floor[q] = max(floor[q], best[q][0])
        parts = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        keep = parts[2] >= floor[parts[0]]
        return parts[0][keep], parts[1][keep], parts[2][keep], scored


def best_rows(table: pa.Table, k: int) -> pa.Table:
    """The k best rows of each ``query`` (score falling, then id, nulls last)."""
    ordered = table.take(pc.sort_indices(table, sort_keys=[("query", "ascending"), ("score", "descending"), ("id", "ascending")],
                                         null_placement="at_end"))
    query = ordered.column("query").to_numpy()
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return ordered.filter(pa.array(place < k)).combine_chunks()


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """id, n (terms), terms, counts of each document with a query term; and one row of
    statistics a task: documents with a term, their terms, documents of each query term."""
    def run(batches):
        known = vocabulary.value
        stats = np.zeros(len(known) + 2, np.int64)
        kind = None
        for part in slices(batches):
            kind = part.schema.field("id").type
            h, first = find_terms(texts(part.column("text")))
            n = np.diff(first)
            at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == h) if len(known) and len(h) else np.zeros(0, np.int64)
            doc = np.searchsorted(first, hit, side="right") - 1
            cell, count = np.unique(doc * max(len(known), 1) + at[hit], return_counts=True)
            doc, term = cell // max(len(known), 1), cell % max(len(known), 1)
            stats[0] += int((n > 0).sum())
            stats[1] += int(n.sum())
            stats[2:] += np.bincount(term, minlength=len(known))
            edge = np.searchsorted(doc, np.arange(part.num_rows + 1))
            rows = np.flatnonzero(np.diff(edge))
            if len(rows):
                cut = [slice(edge[i], edge[i + 1]) for i in rows]
                yield pa.record_batch([part.column("id").take(pa.array(rows)), pa.array(n[rows]),
                                       pa.array([term[s].astype("<i4").tobytes() for s in cut], pa.binary()),
                                       pa.array([pack(count[s]) for s in cut], pa.binary()), pa.nulls(len(rows), pa.binary())],
                                      names=["id", "n", "terms", "counts", "stats"])
        if kind is not None:
            yield pa.record_batch([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                   pa.array([pack(stats)], pa.binary())], names=["id", "n", "terms", "counts", "stats"])
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, terms binary, counts binary, stats binary")


def _ranked(stored: DataFrame, plan, k: int) -> DataFrame:
    """(query, score, id): each task's k best documents of every query."""
    def run(batches):
        queries, weight, n_docs, n_terms = plan.value
        size = len(weight)
        members = np.zeros((size, len(queries)))
        for q, terms in enumerate(queries):
            members[terms, q] = 1
        order = np.argsort(-weight, kind="stable")
        projection = np.random.default_rng(7).choice([-1.0, 1.0], (size, SKETCH))
        floor = np.zeros(len(queries))
        kept = None
        for batch in batches:
            step = max(1, SHARD_CELLS // max(size, 1))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                n = part.column("n").to_numpy()
                terms = [np.frombuffer(b, "<i4") for b in part.column("terms").to_pylist()]
                counts = [unpack(b, len(t)) for b, t in zip(part.column("counts").to_pylist(), terms)]
                row = np.repeat(np.arange(len(n)), [len(t) for t in terms])
                term, count = np.concatenate(terms), np.concatenate(counts)
                m = discounts(n, n_docs, n_terms)
                scores = np.zeros((len(n), size))
                scores[row, term] = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m[row]))
                query, doc, score, _ = Shard(scores, projection).search(members, order, queries, floor, k)
                made = pa.table({"query": query.astype(np.int64), "score": score.astype(np.int64), "id": part.column("id").take(pa.array(doc))})
                kept = best_rows(made if kept is None else pa.concat_tables([kept, made]), k)
                # the k-th best of all shards so far
                q = kept.column("query").to_numpy()
                full = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == k - 1)
                floor[q[full]] = np.maximum(floor[q[full]], kept.column("score").to_numpy()[full])
        if kept is not None:
            yield from kept.to_batches()
    kind = stored.schema["id"].dataType.simpleString()
    return (stored.where("terms is not null").select("id", "n", "terms", "counts")
            .mapInArrow(run, f"query long, score long, id {kind}"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """The k best documents of each row of ``items``: item_id, rank, doc_id, score.

    Every document row counts (repeated ids too); null texts hold no term, so they
    neither count nor match.  A row of ``items`` is a query of its own, whatever its
    id; one without terms, or whose terms no document holds, gives no rows.  Equal
    scores are ranked by id, null ids last.  An empty table on either side gives an
    empty result.  Other columns are not looked at."""
    spark = docs.sparkSession
    base = f"{shared_dir(spark)}/search/{uuid.uuid4().hex}"
    (items.select(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item_id"), F.col(query_col).cast("string").alias("text"))
     .write.parquet(f"{base}/items"))
    asked = spark.read.parquet(f"{base}/items")
    blocks = -(-asked.count() // BLOCK_ITEMS)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def terms_of(batches):
        for part in slices(batches):
            h, first = find_terms(texts(part.column("text")))
            yield pa.record_batch([part.column("row"), pa.array([np.unique(h[a:b]).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                                  names=["row", "terms"])
    made = []
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "text")
        got = some.mapInArrow(terms_of, "row long, terms binary").where("length(terms) > 0").orderBy("row").collect()
        if not got:
            continue
        hashes = [np.frombuffer(r["terms"], np.uint64) for r in got]
        known = np.unique(np.concatenate(hashes))
        vocabulary = spark.sparkContext.broadcast(known)
        _vectors(rows, vocabulary).write.parquet(f"{base}/vectors{block}")
        stored = spark.read.parquet(f"{base}/vectors{block}")
        stats = total(stored, "stats", len(known) + 2)
        plan = spark.sparkContext.broadcast(([np.searchsorted(known, h) for h in hashes], weights(int(stats[0]), stats[2:]), int(stats[0]), int(stats[1])))
        names = spark.createDataFrame([(q, r["row"]) for q, r in enumerate(got)], "query long, row long")
        _ranked(stored, plan, k).join(F.broadcast(names), "query").select("row", "score", "id").write.parquet(f"{base}/best{block}")
        made.append(f"{base}/best{block}")
    if not made:
        kinds = [df.schema[c].dataType.simpleString() for df, c in ((asked, "item_id"), (rows, "id"))]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    best = spark.read.parquet(*made)
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("row", "item_id"), "row").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
