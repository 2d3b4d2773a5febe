"""Operator 12: fill-in-the-middle transformation, cut by a wavelet matrix over character classes.

Each code point has a class: white space, line feed, inner or last character of a word, and
whether it ends its text (``classes``). The classes of a batch of texts stand in a wavelet matrix:
one packed bit vector for each bit of the class, with running popcounts, so that the rank of a
class before any place is two look-ups a level. The units that end before a place are the sum
of the ranks of the classes that end a unit (``ENDS``), and the end of the k-th unit of a text
is found by bisection on that sum, for all cuts of the batch at once.

A text of n units is cut after the smaller of h1 % (n + 1) and h2 % (n + 1) and after the
larger; h1 to h4 are the first four groups of eight hex digits of sha256 of ``seed:doc_id``.
It stays plain if it is empty, holds one of the sentinels, or h3 % 100 >= ``rate``; otherwise its
parts are joined as suffix-prefix-middle if h4 % 100 < ``spm``, else as prefix-suffix-middle.

Defined results: a NULL text is empty; a NULL ``doc_id`` is written as nothing after the seed;
rows are independent, so repeated ones come out alike; a text of any length is one row of one
task, and its batch ends with it; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from candlegap.llm.common import read_table, sliced

SEED = 42
RATE = 50
SPM = 80
#: Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, SPM_FORM, PSM_FORM = "plain", "spm", "psm"

#: Code points whose wavelet matrix is built at once (a longer text is taken alone).
PIECE = 1 << 19
SPACE, LINE, INNER, LAST, FINAL = 0, 1, 2, 3, 4
CLASS_BITS = 3
#: Classes that end a unit: words with the white space before them (what follows the last word
#: is a unit of its own), lines with their line feed, or single code points.
ENDS = {"words": (LAST, LAST + FINAL, SPACE + FINAL, LINE + FINAL),
        "lines": (LINE, SPACE + FINAL, LINE + FINAL, LAST + FINAL),
        "characters": (SPACE, LINE, INNER, LAST, SPACE + FINAL, LINE + FINAL, LAST + FINAL)}


def classes(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each code point of texts that end (exclusively) at ``ends``."""
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    out = np.where(space, np.where(codes == 10, LINE, SPACE), INNER).astype(np.uint8)
    closes = np.zeros(len(codes), bool)
    closes[:-1] = space[1:]
    final = ends[np.diff(ends, prepend=0) > 0] - 1
    closes[final] = True
    out[closes & ~space] = LAST
    out[final] += FINAL
    return out


class WaveletMatrix:
    """Ranks and selections of the symbols of a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int = CLASS_BITS) -> None:
        self.n, self.bits = len(symbols), bits
        self.words, self.before, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % 8 + 8)).view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(self.n - int(bit.sum()))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level before each place."""
        word, off = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[level][word] & ((np.uint64(1) << off) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(low)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        start, at = np.zeros_like(at), at
        for level in range(self.bits):
            if (symbol >> (self.bits - 1 - level)) & 1:
                start, at = (self.zeros[level] + self._ones(level, x) for x in (start, at))
            else:
                start, at = (x - self._ones(level, x) for x in (start, at))
        return at - start

    def boundaries(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of ``symbols`` stand before each place: the sum of their ranks."""
        return sum(self.rank(s, at) for s in symbols)

    def select(self, symbols: tuple[int, ...], low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The least place of [low, high] before which ``k`` more of ``symbols`` stand than before
        ``low``, by bisection on the ranks. There must be as many."""
        low, high = low.copy(), high.copy()
        wanted = self.boundaries(symbols, low) + k
        while len(at := np.flatnonzero(low < high)):
            middle = (low[at] + high[at]) >> 1
            enough = self.boundaries(symbols, middle) >= wanted[at]
            high[at] = np.where(enough, middle, high[at])
            low[at] = np.where(enough, low[at], middle + 1)
        return low


@dataclass(frozen=True)
class Infill:
    """One text's transformation; the parts are places in the text."""

    units: int
    form: str
    first: int
    second: int
    output: str


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    text = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(text[k:k + 8], 16) for k in (0, 8, 16, 24))


def _joined(text: str, form: str, a: int, b: int) -> str:
    if form == PSM_FORM:
        return "".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))
    return "".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))


def restored(output: str, form: str) -> str:
    """The text that ``output`` was made from. No part holds a sentinel, and none can arise
    where a part meets one, so the first of each is the one that was put there."""
    if form == PLAIN:
        return output
    inner = SUFFIX if form == PSM_FORM else PREFIX
    one, rest = output[len(PREFIX):].split(inner, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == PSM_FORM else two + middle + one


def _group(ids: list, texts: list[str], unit: str, rate: int, spm: int, seed: int) -> Iterator[Infill]:
    """Texts that are cut together."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    matrix, symbols = WaveletMatrix(classes(codes, ends)), ENDS[unit]
    units = matrix.boundaries(symbols, ends) - matrix.boundaries(symbols, starts)
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(len(ids), 4)
    cut = drawn[:, :2] % (units + 1)[:, None]
    cut.sort(axis=1)
    plain = (units == 0) | (drawn[:, 2] % 100 >= rate)
    plain |= [any(s in t for s in (PREFIX, SUFFIX, MIDDLE)) for t in texts]
    at = np.flatnonzero(~plain)
    places = np.zeros((len(texts), 2), np.int64)
    for k in (0, 1):
        places[at, k] = matrix.select(symbols, starts[at], ends[at], cut[at, k]) - starts[at]
    for n, text, p, (a, b), h4 in zip(units.tolist(), texts, plain, places.tolist(), drawn[:, 3].tolist(), strict=True):
        form = PLAIN if p else SPM_FORM if h4 % 100 < spm else PSM_FORM
        yield Infill(n, form, a, b, text if p else _joined(text, form, a, b))


def infill(ids: list, texts: list[str], unit: str = "words", rate: int = RATE, spm: int = SPM,
           seed: int = SEED) -> Iterator[Infill]:
    """Each text's transformation, texts of at most ``PIECE`` code points together."""
    at = 0
    while at < len(texts):
        end, held = at + 1, len(texts[at])
        while end < len(texts) and held + len(texts[end]) <= PIECE:
            held += len(texts[end])
            end += 1
        yield from _group(ids[at:end], texts[at:end], unit, rate, spm, seed)
        at = end


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_TEXTS = pa.schema([*list(_DIGESTS)[:5], ("output", pa.string())])
_DIGEST_DDL = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
               "output_sha256 string, restored_sha256 string")
_TEXT_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def fill_in_middle(docs: DataFrame, unit: str = "words", rate: int = RATE, spm: int = SPM, seed: int = SEED,
                   digests: bool = False) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and the ``output`` text of every document, or
    with ``digests`` that of the output and of the text restored from it."""
    if unit not in ENDS:
        raise ValueError(f"unit must be one of {tuple(ENDS)}, not {unit!r}")
    schema = _DIGESTS if digests else _TEXTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches):
            texts = [t or "" for t in cols["text"]]
            rows = []
            for doc_id, x in zip(cols["doc_id"], infill(cols["doc_id"], texts, unit, rate, spm, seed), strict=True):
                sizes = (None, None) if x.form == PLAIN else (x.first, x.second - x.first)
                last = (_sha(x.output), _sha(restored(x.output, x.form))) if digests else (x.output,)
                rows.append((doc_id, x.units, x.form, *sizes, *last))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, _DIGEST_DDL if digests else _TEXT_DDL)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(read_table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


ORACLE_OP12 = rf"""
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM given),
cut AS (
  SELECT *, CASE WHEN n = 0 OR c >= {RATE} OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}')
                   OR contains(text, '{MIDDLE}') THEN '{PLAIN}' WHEN d < {SPM} THEN '{SPM_FORM}' ELSE '{PSM_FORM}' END AS form,
         array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN text WHEN '{PSM_FORM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
