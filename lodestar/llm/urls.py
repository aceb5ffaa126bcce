"""URL filters: policy rules, then logistic regression on hashed character n-grams.

Rules name a host (with its subdomains) and a path prefix; the longest that fits
decides.  Every other URL is judged by a logistic regression over the character
3- to 5-grams of its host and of its path, hashed into a fixed number of weights.
The model is fitted on a small labelled URL table; scoring is map-side with the
weights in the closure (a fixed size, whatever the data).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1 << 16
GRAMS = (3, 4, 5)
#: Most labelled URLs of each label that the model is fitted on (by hash order).
FIT_URLS = 2_000
# fixed values: words of host names that mark a URL of the labelled table as blocked
BLOCKED_WORDS = ("adult", "ads", "bet", "bets", "casino", "gambling", "pills", "porn", "spam", "track", "tracker", "viagra", "xxx")


@dataclass(frozen=True)
class UrlRule:
    verdict: str   # allow or block
    pattern: str   # host, then path from the first slash on

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.locate("://", url) > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule (ties: the smaller text); null when
    none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.pattern).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def features(host: str, path: str) -> np.ndarray:
    """Weight indices of the n-grams of a host and a path, apart from each other."""
    out = []
    for name, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        b = text.encode("utf-8", "replace")
        if len(b) > 2:
            out += [zlib.crc32(name.encode() + b[i:i + n]) % DIMENSIONS for n in GRAMS for i in range(len(b) - n + 1)]
    return np.array(out, dtype=np.int64)


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        """Probability that the URL is to be blocked."""
        f = features(host, path)
        z = self.bias + (self.weights[f].sum() / np.sqrt(len(f)) if len(f) else 0.0)
        return float(1 / (1 + np.exp(-z)))


def fit(rows: list[tuple[str, str, int]], rounds: int = 120, rate: float = 2.0, ridge: float = 1e-4) -> UrlModel:
    """Logistic regression on (host, path, blocked) rows; each label has half the
    weight.  Without rows of both labels nothing is blocked."""
    y = np.array([r[2] for r in rows], dtype=float)
    if not len(rows) or y.min() == y.max():
        return UrlModel(np.zeros(DIMENSIONS), -1.0)
    parts = [features(h, p) for h, p, _ in rows]
    size = np.array([max(1, len(f)) for f in parts])
    at = np.concatenate(parts)
    row = np.repeat(np.arange(len(rows)), [len(f) for f in parts])
    x = 1 / np.sqrt(size)[row]
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, b, v = np.zeros(DIMENSIONS), 0.0, np.full(DIMENSIONS, 1e-8)
    for _ in range(rounds):
        z = b + np.bincount(row, weights=w[at] * x, minlength=len(rows))
        gap = each * (1 / (1 + np.exp(-z)) - y)
        g = np.bincount(at, weights=gap[row] * x, minlength=DIMENSIONS) + ridge * w
        v += g * g
        w -= rate * g / np.sqrt(v) * 0.1
        b -= rate * gap.sum()
    return UrlModel(w, b)


def labelled_urls(pages: DataFrame, url_col: str = "url", most: int = FIT_URLS) -> DataFrame:
    """A small labelled table (url_host, url_path, blocked): at most ``most`` distinct URLs
    of each label, by hash order; blocked are hosts with a word of ``BLOCKED_WORDS``."""
    rows = pages.select(host_of(F.col(url_col)).alias("url_host"), path_of(F.col(url_col)).alias("url_path")).where("url_host <> ''")
    words = F.split("url_host", r"[.\-_]")
    marked = rows.withColumn("blocked", F.arrays_overlap(words, F.array(*[F.lit(w) for w in BLOCKED_WORDS])).cast("int")).distinct()
    key = F.xxhash64("url_host", "url_path")
    parts = [marked.where(F.col("blocked") == y).orderBy(key, "url_host", "url_path").limit(most) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def train_url_model(labelled: DataFrame, most: int = 4 * FIT_URLS) -> UrlModel:
    """Fit on a small table (url_host, url_path, blocked), at most ``most`` rows of it."""
    key = F.xxhash64("url_host", "url_path")
    rows = labelled.where("blocked is not null").orderBy(key, "url_host", "url_path", "blocked").limit(most).collect()
    return fit([(r["url_host"] or "", r["url_path"] or "", int(r["blocked"])) for r in rows])


def filter_urls(pages: DataFrame, model: UrlModel, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url",
                threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, blocked_p) of every row.  A null url, or one
    without ``://``, has an empty host and path and is allowed; repeated rows and null
    ids are judged like any row."""
    url = F.col("_url")
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_url")).select(
        "page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"))

    def run(batches):
        known: dict[tuple[str, str], float] = {}
        for b in batches:
            scores = []
            for pair in zip(b.column("host").to_pylist(), b.column("path").to_pylist()):
                if pair not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[pair] = model.score(*pair) if pair[0] else 0.0
                scores.append(known[pair])
            yield pa.record_batch([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, "blocked_p"])

    kind = named.schema["page_id"].dataType.simpleString()
    scored = named.mapInArrow(run, f"page_id {kind}, host string, path string, blocked_p double")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("blocked_p") > threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "blocked_p")
