"""Operator 9: threshold-scaled sketches of documents.

A fingerprint retains every five-word shingle hash below a fixed fraction of the hash range.
Whether a hash is retained depends on nothing but itself, so sketches merge by union, and
their overlap estimates containment between documents of very unequal length:

    likeness(A, B) = |A and B| / min(|A|, |B|)

One hash in ``SCALE`` is kept, so a text of 20 shingles keeps five on average; likenesses of
shorter texts rest on fewer. A document none of whose hashes is low enough keeps its least one
(which a union with lower hashes drops again, so merging still gives the sketch of the joined
set). A longer document that holds this shingle does not keep it: in the query such a
stand-in is looked up in the other document's whole set.

The query compares each document with an edited copy, whose last half is replaced by the next
document's beginning, and with the next document. Documents are dealt to ranges of ``doc_id``
with stated bounds; each range gets the first document of the next one (the last range that of
the first), so each task finishes all pairs of its ranges and nothing is written in between.

Defined results: a NULL text is empty; texts without words have the empty fingerprint, two of
which have likeness 1 and any other pair with one 0; rows that repeat a ``doc_id`` follow one
another by text; NULL ``doc_id`` come first; a single document is its own next; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlegap.llm.common import read_table, sliced, written
from candlegap.llm.shingles import shingle_sets

#: One hash in so many is retained.
SCALE = 4
_RESULT = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double")


def sketch(s: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The retained hashes of a set (ascending)."""
    kept = s[:np.searchsorted(s, np.uint64((1 << 64) // scale))]
    return kept if len(kept) or not len(s) else s[:1]


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of the union."""
    return sketch(np.union1d(a, b), scale)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    least = min(len(a), len(b))
    if least == 0:
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least


def compared(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """The likeness of the sketches of two whole sets, where a stand-in counts as kept by a
    set that holds it."""
    x, y = sketch(a, scale), sketch(b, scale)
    bound = np.uint64((1 << 64) // scale)
    lone = [s[:1] for s in (x, y) if len(s) and s[0] >= bound]
    if lone and len(x) and len(y):
        return float(any(len(np.intersect1d(one, a)) and len(np.intersect1d(one, b)) for one in lone))
    return likeness(x, y)


def packed(a: np.ndarray) -> bytes:
    """Hashes in order, big-endian: their hex digits are the fingerprint string."""
    return a.astype(">u8").tobytes()


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()),
                    ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _batch(ids: list, texts: list[str], sets: list[np.ndarray], closed: list[bool]) -> pa.RecordBatch:
    """The rows of all documents but the last, and but those that only follow another."""
    at = [i for i in range(len(texts) - 1) if not closed[i]]
    changed = [edited(texts[i], texts[i + 1]) for i in at]
    rows = []
    for i, new, s in zip(at, changed, shingle_sets(changed), strict=True):
        rows.append((ids[i], len(texts[i]), hashlib.sha256(new.encode("utf-8")).digest(), packed(sketch(sets[i])),
                     packed(sketch(s)), compared(sets[i], s), compared(sets[i], sets[i + 1])))
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges one after another, each closed by the document that follows it."""
    ids, texts, sets, closed = [], [], [], []
    for cols in sliced(batches):
        given = [t or "" for t in cols["text"]]
        ids, texts, closed = ids + cols["doc_id"], texts + given, closed + cols["follows"]
        sets += shingle_sets(given)
        yield _batch(ids, texts, sets, closed)
        ids, texts, sets, closed = ids[-1:], texts[-1:], sets[-1:], closed[-1:]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likenesses."""
    docs = docs.select("doc_id", "text")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quantiles = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0]
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(quantiles or []))]).cast("array<long>")
    # NULL is in the first range, as it sorts
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda b: b < F.col("doc_id"))))
    dealt = docs.withColumn("part", part)
    order = F.struct(F.col("doc_id").isNotNull().alias("set"), "doc_id", F.col("text").isNotNull().alias("some"), "text")
    heads = written(dealt.groupBy("part").agg(F.min(order).alias("head")), "heads")  # one row of each range
    before = Window.orderBy("part")
    follows = (heads.select("part").withColumn("to", F.lag("part").over(before))
               .withColumn("to", F.coalesce("to", F.max("part").over(Window.partitionBy(F.lit(0))))))
    closing = (heads.join(follows, "part").select(F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"),
                                                  F.col("to").alias("part"), F.lit(True).alias("follows")))
    rows = dealt.withColumn("follows", F.lit(False)).unionByName(closing)
    whole = (rows.repartitionByRange(ranges, "part").sortWithinPartitions("part", "follows", "doc_id", "text")
             .select("doc_id", "text", "follows").mapInArrow(_neighbours, _RESULT))
    return whole.select(*[F.lower(F.hex(c)).alias(c) if kind == "binary" else F.col(c) for c, kind in whole.dtypes])


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text"))
