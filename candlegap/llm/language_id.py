"""Operator 10: language identification with language-bitmask n-gram filters.

Each language has a Bloom filter of the character 4-grams that mark it. The filters share
their hash positions and are stored bit-sliced: cell p is a mask with one bit per language,
so the AND of an n-gram's cells names all languages that contain it at once. A text's
n-grams are looked up, the masks are counted per language, and the count h of n lookups is
corrected for the filter's false positives, f = (share of set cells) ** hashes:

    c = max(0, (h - n f) / (1 - f))

The largest corrected count decides; ``score`` is its share of all corrected counts.

Learning: from a sample of at most ``TRAIN_DOCS`` labelled documents (those first by a hash
of their id, rows with one id in the order they are read), whole texts, of the documents whose ``crc32(doc_id) mod 3`` is not 1. An n-gram goes to
each language in which it is at least ``DISTINCT`` times as frequent as in its most frequent
language, and seen ``MIN_COUNT`` times. The filters are as large as this bounded sample asks for.

Defined results: ``und`` with score 0 for NULL and empty texts, texts without a letter, and
where nothing could be learned; a text with letters but no n-gram has the language with the
most sampled documents, score 0; ties go to the language first in order; a NULL ``doc_id``
is never learned from and not held out; repeated rows are predicted alike.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlegap.llm.common import read_table, sliced, spread

TRAIN_DOCS = 8_000
GRAM = 4
HASHES = 3
CELLS_PER_GRAM = 16
DISTINCT = 0.3
MIN_COUNT = 3
#: Code points worked on at once inside a task.
PIECE = 1 << 18
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number of each n-gram, its hash, whether each text has a letter), a bounded
    piece at a time. An n-gram is four code points, other characters than letters being one
    and the same, of which the middle two are letters."""
    edge, known = GRAM - 1, _letters()
    codes, owners, held = [], [], 0

    def out():
        code, owner = np.concatenate(codes), np.concatenate(owners)
        letter = known[code]
        code = np.where(letter, code, 0).astype(np.uint64)
        has = np.zeros(len(texts), bool)
        has[owner[letter]] = True
        n = len(code) - edge
        keep = np.flatnonzero(letter[1:n + 1] & letter[2:n + 2] & (owner[:n] == owner[edge:]))
        h = np.zeros(len(keep), np.uint64)
        for k in range(GRAM):
            h += code[keep + k] * _FACTORS[k]
            h ^= h >> np.uint64(29)
            h *= _FACTORS[(k + 1) % GRAM]
        h ^= h >> np.uint64(32)
        return owner[keep], h, has

    for i, text in enumerate(texts):
        if not text:
            continue
        code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
        for at in range(0, max(1, len(code) - edge), PIECE):
            piece = code[at:at + PIECE + edge]
            codes.append(piece)
            owners.append(np.full(len(piece), i, np.int32))
            held += len(piece)
            if held >= PIECE:
                yield out()
                codes, owners, held = [], [], 0
    if codes:
        yield out()


@dataclass(frozen=True)
class LanguageFilters:
    """Bit-sliced filters: ``cells[p]`` is a mask over ``languages``, in words of 64."""

    languages: list[str]
    common: str
    cells: np.ndarray  # (cells, words) uint64
    false_positive: np.ndarray

    @staticmethod
    def build(languages: list[str], common: str, hashes: np.ndarray, owner: np.ndarray) -> LanguageFilters:
        largest = max(1, np.bincount(owner, minlength=1).max()) if len(owner) else 1
        n = 1 << int(CELLS_PER_GRAM * largest - 1).bit_length()
        cells = np.zeros((n, (len(languages) + 63) // 64), np.uint64)
        bit = np.uint64(1) << (owner % 64).astype(np.uint64)
        for p in _positions(hashes, n):
            np.bitwise_or.at(cells, (p, owner // 64), bit)
        fill = np.array([np.mean(cells[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(languages))])
        return LanguageFilters(languages, common, cells, fill ** HASHES)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        n, langs = len(texts), len(self.languages)
        looked, hits, has = np.zeros(n), np.zeros((n, langs)), np.zeros(n, bool)
        for owner, h, letters in grams(texts):
            has |= letters
            looked += np.bincount(owner, minlength=n)
            masks = None
            for p in _positions(h, len(self.cells)):
                masks = self.cells[p] if masks is None else masks & self.cells[p]
            for k in range(langs):
                bit = (masks[:, k // 64] >> np.uint64(k % 64)).astype(np.uint8) & 1
                hits[:, k] += np.bincount(owner, weights=bit, minlength=n)
        if not langs:
            return [UNKNOWN] * n, [0.0] * n
        corrected = np.maximum(0, (hits - looked[:, None] * self.false_positive) / (1 - self.false_positive))
        best, total = corrected.argmax(axis=1), corrected.sum(axis=1)
        score = np.divide(corrected.max(axis=1), total, out=np.zeros(n), where=total > 0)
        names = [self.languages[b] if t > 0 else self.common if a else UNKNOWN
                 for b, t, a in zip(best, total, has, strict=True)]
        return names, score.tolist()


def _positions(h: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    step = (h >> np.uint64(33)) | np.uint64(1)
    for k in range(HASHES):
        yield ((h + np.uint64(k) * step) & np.uint64(cells - 1)).astype(np.int64)


def fold(doc_id: str = "doc_id") -> Column:
    """0, 1 or 2 by the document's id; 1 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> LanguageFilters:
    """Filters from a bounded sample of the labelled documents that are not held out."""
    labelled = docs.where((fold() != 1) & F.col("lang").isNotNull())
    # hashes alone are ordered; texts are read for the rows up to the hash that ends the sample
    hashed = F.xxhash64("doc_id")
    first = labelled.select(hashed.alias("h")).orderBy("h").limit(train_docs + 1)
    end = first.agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("h")).first()
    if end["n"] > train_docs:
        before = first.where(F.col("h") < F.lit(end["h"])).count()
        sample = labelled.where(hashed < F.lit(end["h"]))
        # rows that tie with it fill the sample up: copies of one id may be any number of rows
        ties = labelled.where(hashed == F.lit(end["h"])).limit(train_docs - before)
        sample = sample.select("lang", "text").unionByName(ties.select("lang", "text"))
    else:
        sample = labelled.select("lang", "text")
    sample = sample.transform(spread)  # at most train_docs rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches):
            langs = sorted(set(cols["lang"]))
            number = np.array([langs.index(v) for v in cols["lang"]])
            for owner, h, _ in grams(cols["text"]):
                for k, lang in enumerate(langs):
                    value, n = np.unique(h[number[owner] == k], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(value), pa.string()),
                                                      "gram": pa.array(value.view(np.int64)), "n": pa.array(n)})

    counted = (sample.mapInArrow(count, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    table = counted.toPandas()  # bounded: n-grams of at most train_docs documents
    if not len(table):
        return LanguageFilters.build([], UNKNOWN, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    totals = table.groupby("lang")["n"].sum()
    languages = sorted(totals.index)
    table["share"] = table["n"] / table["lang"].map(totals)
    table = table[(table["n"] >= MIN_COUNT) & (table["share"] >= DISTINCT * table.groupby("gram")["share"].transform("max"))]
    owner = table["lang"].map({v: k for k, v in enumerate(languages)}).to_numpy(np.int64)
    hashes = table["gram"].to_numpy(np.int64).view(np.uint64)
    return LanguageFilters.build(languages, totals.idxmax(), hashes, owner)


def identify(docs: DataFrame, filters: LanguageFilters, kept: list[str]) -> DataFrame:
    """``kept`` columns with ``lang_pred`` and ``score``; reads only the text."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # size bounded by the sample
    columns = list(dict.fromkeys([*kept, "text"]))
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names, scores = shared.value.predict(part.column(0).flatten()[place].to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 names=["doc", "lang_pred", "score"])

    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    kind = given.schema["doc"].dataType.simpleString()
    return given.mapInArrow(run, f"doc {kind}, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc.doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return identify(docs, learn(docs), ["doc_id"]).select(
        "doc.doc_id", held_out.alias("held_out"), "lang_pred", "score")
