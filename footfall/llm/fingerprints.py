"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the k smallest of the 40-bit hashes of a text's shingles (runs of five
words between white space; a shorter text is one shingle), written as base64 of 5 bytes
each, ascending. A text without words, null included, has the empty sketch. The sketch
of a union is made of the two sketches alone, so parts may be sketched anywhere and
merged. Sketches of fewer than k hashes are whole sets, and what is estimated from two
of them is exact.
"""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from footfall.llm.hashing import shingle_sets
from footfall.operators.skew import top_per_group

K = 256
SHINGLE = 5
#: Ranges of doc_id: at least so many, so that tasks get about the same, and one for each task.
LEAST_BUCKETS = 1024
BITS = 40
SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, distinct_shingles double"
)


def sketch(shingles: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes of ascending 64-bit shingle hashes."""
    for some in (shingles[: 2 * k], shingles):
        values = some >> np.uint64(64 - BITS)
        values = values[np.diff(values, prepend=values[:1] + np.uint64(1)) != 0]
        if len(values) >= k or len(some) == len(shingles):
            break
    return values[:k]


def encode(values: np.ndarray) -> str:
    return base64.b64encode(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()).decode()


def decode(text: str) -> np.ndarray:
    low = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 5)
    return np.pad(low, ((0, 0), (3, 0))).reshape(-1).view(">u8").astype(np.uint64)


def union(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness; 1 for two empty texts, 0 for an empty and another one."""
    both = union(a, b, k)
    if not len(both):
        return 1.0
    return len(np.intersect1d(np.intersect1d(both, a, True), b, True)) / len(both)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**BITS / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 if a is empty."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct(union(a, b, k), k)
    return min(1.0, shared / distinct(a, k))


@F.pandas_udf(T.DoubleType())
def containment_of(a: pd.Series, b: pd.Series) -> pd.Series:
    """Estimated containment of fingerprint a in fingerprint b."""
    return pd.Series([containment(decode(x), decode(y)) for x, y in zip(a, b)])


@F.pandas_udf(T.DoubleType())
def resemblance_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([resemblance(decode(x), decode(y)) for x, y in zip(a, b)])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _hashes(texts: pd.Series) -> pd.Series:
    return pd.Series([decode(t).astype(np.int64) for t in texts])


def merge_fingerprints(prints: DataFrame, by: str, column: str = "fingerprint", k: int = K) -> DataFrame:
    """by, fingerprint: the sketch of all texts of each group, from their sketches.

    Hashes are made distinct and cut to k a group before the last shuffle, so a group of
    any size ends as k numbers.
    """
    rows = prints.select(by, F.explode(_hashes(column)).alias("hash")).distinct()
    least = top_per_group(rows, [by], [F.col("hash")], k)

    @F.pandas_udf("string")
    def encoded(hashes: pd.Series) -> pd.Series:
        return pd.Series([encode(np.sort(np.asarray(h, np.uint64))) for h in hashes])

    return least.groupBy(by).agg(F.collect_list("hash").alias("h")).select(by, encoded("h").alias("fingerprint"))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """bucket, tail, doc_id, text: ranges of documents by doc_id, each with the one that follows it.

    Rows with `tail` end a bucket: they are the first document of the next bucket that
    has any, after the last bucket of the first one. Bounds are quantiles of doc_id, one
    for each bucket; null ids come first. Only bounds and first ids reach the driver.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    low = -(2**63)
    keyed = rows.withColumn("key", F.coalesce("doc_id", F.lit(low)))
    cuts = [i / parts for i in range(1, parts)]
    bounds = keyed.agg(F.percentile_approx("key", cuts or [0.5], 5 * parts + 1000).alias("b")).first()["b"] or []
    edges = np.unique(np.array(bounds if cuts else [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(np.int64), "right").astype(np.int32))

    bucketed = keyed.withColumn("bucket", bucket_of("key"))
    firsts = bucketed.groupBy("bucket").agg(F.min("key").alias("key")).orderBy("bucket").collect()
    if not firsts:
        return keyed.select(F.lit(0).alias("bucket"), F.lit(False).alias("tail"), "key", "doc_id", "text")
    before = docs.sparkSession.createDataFrame(
        [(firsts[i - 1]["bucket"], r["key"]) for i, r in enumerate(firsts)], "bucket int, key bigint"
    )
    heads = keyed.join(F.broadcast(before), "key").groupBy("bucket", "key").agg(F.min("text").alias("text"))
    tails = heads.select("bucket", F.lit(True).alias("tail"), "key", F.lit(None).cast("bigint").alias("doc_id"), "text")
    own = bucketed.select("bucket", F.lit(False).alias("tail"), "key", "doc_id", "text")
    return own.union(tails)


def _lines(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One output row for each document, once the document after it has been seen."""
    held = None  # (doc_id, text, sketch) of the last document so far
    for batch in batches:
        tails, ids = batch.column("tail").to_pylist(), batch.column("doc_id").to_pylist()
        texts, column = batch.column("text").to_pylist(), batch.column("text")
        prints = [sketch(s, k) for s in shingle_sets(column, SHINGLE)]
        pending = []  # (doc_id, text, sketch, text and sketch of the next)
        for tail, doc_id, text, mine in zip(tails, ids, texts, prints):
            if held is not None:
                pending.append((*held, text, mine))
            held = None if tail else (doc_id, text, mine)
        if pending:
            yield _finished(pending, k)


def _finished(rows: list, k: int) -> pa.RecordBatch:
    edited = []
    for _, text, _, after, _ in rows:
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + after[:cut])
    changed = [sketch(s, k) for s in shingle_sets(pa.array(edited, pa.large_string()), SHINGLE)]
    columns = [
        [r[0] for r in rows],
        [len(r[1]) for r in rows],
        [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        [encode(r[2]) for r in rows],
        [encode(c) for c in changed],
        [resemblance(r[2], c, k) for r, c in zip(rows, changed)],
        [resemblance(r[2], r[4], k) for r in rows],
        [distinct(r[2], k) for r in rows],
    ]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """A row of SCHEMA for each row of `docs`.

    The edited text is the text with its last quarter of code points replaced by as many
    of the beginning of the document that follows by doc_id (the last one is followed by
    the first; equal ids follow each other in order of their texts). Null text counts as
    empty. Columns other than doc_id and text are not read. Texts are shuffled once,
    into ranges of doc_id.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = with_next(docs, max(LEAST_BUCKETS, parts))
    ordered = ranged.repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", "key", "text")
    return ordered.select("tail", "doc_id", "text").mapInArrow(lambda batches: _lines(batches, k), SCHEMA)
