"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text.  The ledger
holds one row per scanned (blob, rule version) with the spans found; a scan takes
the pairs the ledger lacks, reads one representative version of each such blob,
applies just the missing rules and joins the findings of all its blobs back to
every path.  Copies are scanned once; a changed rule has a new version and is run
again over every blob, the others are not.

Matches and their places come from splitting a text at the rule's pattern: the
lengths of the parts and of the matches between them add up to code point offsets.
Arrays are folded in groups of ``GROUP``, and long texts are cleaned in blocks of
``BLOCK`` code points, so that a fold never copies a long result once a match.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import shared_dir

#: Matches folded together; code points of a text cleaned together; spans up to which a
#: text is cleaned as one block.
GROUP, BLOCK, FEW = 256, 1 << 14, 64

SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"
LEDGER_SCHEMA = f"blob string, rule string, spans {SPAN}"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those shorter than ``least`` (in ``group``) are dropped."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0

    @property
    def version(self) -> str:
        text = f"{self.pattern}|{self.least}|{self.group}"
        return f"{self.kind}@{hashlib.sha256(text.encode()).hexdigest()[:12]}"


# a private key: from its BEGIN line to the END line or, if that is missing, over the
# header and base64 lines that follow (line ends may be written as \n, as in JSON);
# possessive quantifiers, so that a long key takes no stack and no second scan
_LABEL = r"[A-Z0-9\x20]{0,40}PRIVATE KEY(?:\x20BLOCK)?-----"
_GAP = r"""(?:[\s"'+,;>#*|]|\\++[nrt])*+"""
_LINE = r"""(?:[\x20\t"'+,;>#*|]|\\++[rt])*+(?:\r?\n|\r|\\++n)""" + _GAP
PEM = (f"-----BEGIN {_LABEL}(?:[^-]*+(?:-{{1,4}}+[^-]++)*+-----END {_LABEL}"
       rf"|(?:{_LINE}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+)*+"
       rf"(?:{_GAP}[A-Za-z0-9+/=]{{24,}}+|{_LINE}[A-Za-z0-9+/=]++(?=[\x20\t]*+(?:[\r\n\"',;\\]|\z)))*+)")

# fixed values: the base rules, in the order that breaks ties of start
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
# further rules of the method
RULES = BASE + (
    Rule("pem", PEM),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("ghtoken", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def _needs(rule: Rule) -> str:
    """The pattern for the first test: whole runs shorter than ``least`` cannot count."""
    if rule.kind == "hex":
        return f"[0-9a-f]{{{rule.least}}}"
    return rule.pattern


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule in ``text``: leftmost, non-overlapping, failing matches dropped."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.slice(F.split(text, rule.pattern, -1), 1, F.size(hits))
    pairs = F.zip_with(parts, hits, lambda p, h: F.struct(
        F.length(p).alias("gap"), F.length(h).alias("size"),
        ((F.length(h) if rule.group == 0 else F.length(F.regexp_extract(h, rule.pattern, rule.group))) >= rule.least).alias("good")))

    # within a group, one fold over its matches: place so far, spans so far
    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["gap"]
        end = start + pair["size"]
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(pair["good"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def shifted(folded: Column) -> Column:
        # where each group starts: one more fold, over the groups
        starts = F.aggregate(folded, F.array(F.lit(0)), lambda acc, f: F.concat(acc, F.array(F.element_at(acc, -1) + f["at"])))
        return F.flatten(F.zip_with(folded, F.slice(starts, 1, F.size(folded)), lambda f, at: F.transform(f["spans"], lambda s: F.struct(
            (s["start"] + at).alias("start"), s["ord"].alias("ord"), (s["end"] + at).alias("end"), s["kind"].alias("kind")))))

    def fold(p: Column) -> Column:
        many = _let(F.transform(_groups(p), lambda g: F.aggregate(g, zero, step)), shifted)
        return F.when(F.size(p) <= GROUP, F.aggregate(p, zero, step, lambda acc: acc["spans"])).otherwise(many)

    found = _let(pairs, fold)
    return F.when(text.rlike(_needs(rule)), found).otherwise(F.array().cast(SPAN))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _groups(items: Column) -> Column:
    """An array cut into arrays of ``GROUP`` items."""
    many = F.ceil(F.size(items) / F.lit(GROUP)).cast("int")
    at = F.when(many > 0, F.sequence(F.lit(0), many - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.slice(items, i * GROUP + 1, F.lit(GROUP)))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(findings, entries): ``findings`` has one row per row of ``versions`` (path, blob,
    spans by start, then rule order); ``entries`` are the new ledger rows, those of blobs
    without a finding included, to be appended to the ledger.

    Null texts count as empty; null paths and repeated rows are kept as they are."""
    shared_dir(versions.sparkSession)
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    addressed = rows.select("path", "blob").checkpoint()
    # one version of each blob, with the rules that its ledger rows lack
    wanted = (addressed.groupBy("blob").agg(F.min("path").alias("path"))
              .withColumn("rule", F.explode(F.array(*[F.lit(r.version) for r in rules]))))
    if ledger is not None:
        wanted = wanted.join(ledger.select("blob", "rule").distinct(), ["blob", "rule"], "left_anti")
    wanted = wanted.groupBy("blob", "path").agg(F.collect_set("rule").alias("wanted"))
    todo = (rows.alias("r").join(wanted.alias("w"), F.col("r.blob").eqNullSafe(F.col("w.blob")) & F.col("r.path").eqNullSafe(F.col("w.path")))
            .select("r.blob", "r.text", "w.wanted"))
    per_rule = F.array(*[F.struct(F.lit(r.version).alias("rule"),
                                  F.when(F.array_contains("wanted", r.version), spans_of(F.col("text"), r, i)).alias("spans"))
                         for i, r in enumerate(rules)])
    # rows that repeat path and text give the same entry again
    entries = (todo.select("blob", F.explode(per_rule).alias("e")).where("e.spans is not null")
               .select("blob", "e.rule", "e.spans").dropDuplicates(["blob", "rule"]).checkpoint())
    known = entries if ledger is None else ledger.select("blob", "rule", "spans").unionByName(entries)
    current = known.where(F.col("rule").isin([r.version for r in rules]) & (F.size("spans") > 0))
    by_blob = (current.dropDuplicates(["blob", "rule"]).groupBy("blob")
               .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
    findings = addressed.join(by_blob, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))
    return findings, entries


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
           path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets (overlapping spans
    by the first one's); texts without a finding, null ones too, are unchanged."""
    findings, _ = scan(docs, ledger, rules, path_col, text_col)
    found = (findings.where(F.size("spans") > 0).select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans"))
             .dropDuplicates(["_blob"]))
    text = F.col(f"`{text_col}`").cast("string")

    def without(block: Column, low: Column, at: Column, spans: Column) -> Column:
        """A block of the text, from code point ``low``, without the spans that start in
        it; what lies before ``at`` belongs to an earlier span."""
        def step(acc: Column, s: Column) -> Column:
            fresh = F.concat(acc["out"], F.substring(block, acc["at"] - low + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(fresh).alias("out"))
        zero = F.struct(at.alias("at"), F.lit("").alias("out"))
        return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(block, acc["at"] - low + 1, F.length(block))))

    def clean_block(block: Column, i: Column) -> Column:
        low = i * BLOCK
        reached = F.array_max(F.transform(F.filter("_spans", lambda s: s["start"] < low), lambda s: s["end"]))
        mine = F.filter("_spans", lambda s: (s["start"] >= low) & (s["start"] < low + BLOCK))
        return without(block, low, F.greatest(low, F.coalesce(reached, F.lit(0))), mine)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    # few spans: the text is one block
    clean = (F.when(F.size("_spans") <= FEW, without(text, F.lit(0), F.lit(0), F.col("_spans")))
             .otherwise(F.array_join(F.transform(blocks, clean_block), "")))
    joined = docs.join(found, F.sha2(F.coalesce(text, F.lit("")), 256) == F.col("_blob"), "left")
    return joined.select(*[F.when(F.col("_spans").isNull(), F.col(f"`{c}`")).otherwise(clean).alias(c) if c == text_col
                           else F.col(f"`{c}`") for c in docs.columns])
