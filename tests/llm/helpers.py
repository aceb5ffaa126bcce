"""Documents with every awkward case, and what brute force makes of words."""

import re

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} tail{i % 31}" for i in range(15_000))
EDGES = [
    (900001, ""), (900002, None), (900003, "   \n\t "), (900004, "one"), (900005, "x " * 400),
    (900006, LONG), (900007, LONG), (900007, LONG), (None, "no id, but words all the same"), (None, None),
    (900008, "Tab\tand\x0bvertical\x0cfeed\r\nline"), (900009, "é ü ß ΑΣ  nbsp em 한글 😀 İ"),
]


def docs_with_edges(spark, sf=SF, partitions=3):
    """The table's documents and the edge cases, with extra columns of clashing names."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows += EDGES
    schema = "doc_id long, text string, fp string, block int, words long, score string, bucket date, rule string, n_words double"
    full = [(d, t, "x", 1, None, "s", None, "r", 0.5) for d, t in rows]
    return rows, spark.createDataFrame(full, schema).repartition(partitions, "text")


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def words(text, lower=False):
    text = text or ""
    if lower:
        text = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", text)
