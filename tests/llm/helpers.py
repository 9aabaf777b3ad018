"""Small tables and brute-force versions shared by the tests of the training-data operators."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

BASE = ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
        "seventeen eighteen nineteen twenty alpha beta gamma delta epsilon zeta eta theta iota kappa").split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))


def shingles(text, k=5):
    w = words(text)
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i: i + k]) for i in range(len(w) - k + 1))


def edge_rows():
    """NULLs, empty and blank texts, ties, repeated rows, a long text, odd white space."""
    text = " ".join(BASE)
    long = " ".join(f"w{i % 977} {BASE[i % 30]}." for i in range(30_000))
    return [
        (1, text, "en", "a", len(text)), (2, text, "en", "a", None), (3, text + " end", None, "b", 1),
        (4, None, "en", "a", None), (5, "", "en", None, 0), (6, " \t\n", None, "b", 3), (7, "One", "en", "c", 3),
        (8, "one", "en", "c", 3), (9, long, "en", "a", len(long)), (10, "a  b\n\nc\td É. don't!!", "fr", "b", 20),
        (11, "NUL\x00 byte   wide　space", "xx", "", 5), (7, "One", "en", "c", 3),
        (12, "x " * 50, "en", "a", 100), (13, "日本語 の 文 です 。", "ja", "b", 5), (None, "no id here at all now", "en", "a", 4),
        (-5, "negative id " + text, "en", None, 9),
    ]


def edge_docs(spark, clash=False):
    df = spark.createDataFrame(edge_rows(), DOCS)
    if clash:  # names that operators use inside or return
        for name in ("size", "score", "id", "h", "cell", "shard", "slot", "target", "taken", "member", "bucket",
                     "length", "row", "piece", "label", "x", "trained", "fingerprint", "rep"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def groups(n, pairs):
    """Smallest member of each node's component."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
