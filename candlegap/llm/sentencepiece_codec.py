"""Operator 1: SentencePiece (merge type) encoding by backtracking, and decoding.

The model merges neighbouring symbols, best score first and leftmost among equals, as
long as the merged string is a piece. Its result is the one segmentation whose adjacent
pieces are all *compatible*: merging the two pieces' characters anew gives the same two
pieces. (A merge across a border involves one border only, and up to that moment the two
spans beside it behaves as they would alone, so pairwise checks suffice.) The search:

1. an Aho-Corasick automaton over the reachable pieces lists the pieces that start at
   each position, longest first;
2. from the left, the longest piece that is compatible with the piece before it is taken;
3. where none fits, the position is marked in a bitfield of failed positions and the piece
   before it gives way to its next shorter one; no position fails twice, so the work is
   linear in the text for bounded piece lengths.

No piece holds the space mark after another character (checked on load, else a text is one
unit), so no merge crosses the border in front of a space mark: a text is cut there and
each distinct unit is searched once per worker and remembered in a bounded table.

Defined results: a NULL or empty text has the begin and end ids only and decodes to the
empty string; characters outside the vocabulary become byte pieces; equal rows give equal
results; a NULL ``doc_id`` passes through; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from candlegap.llm.common import read_table, sliced

SPACE = "▁"
#: Distinct units (about words) that one worker remembers before it starts afresh.
CACHE_UNITS = 500_000
#: Compatibility answers that one worker remembers before it starts afresh.
CACHE_PAIRS = 1_000_000
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def little_endian(i: int) -> bytes:
    return int(i).to_bytes(4, "little")


class _Units(dict):
    """unit -> its ids as little-endian unsigned 32-bit integers; filled on demand."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE_UNITS:
            self.clear()
        ids = self._encode(SPACE + unit)
        if len(unit) <= 64:  # very long units are rare and would fill the table
            self[unit] = ids
        return ids


class PieceCodec:
    """Encoder and decoder over one model's pieces and scores."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
                   for i in range(sp.get_piece_size())]
        ids = {sp.id_to_piece(i): i for i, no in enumerate(special) if not no}
        self.scores = {p: sp.get_score(i) for p, i in ids.items()}
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_fallback = all(sp.is_byte(i) for i in byte_ids)
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.raw = {p: little_endian(i) for p, i in ids.items()}
        self.raw_bytes = [little_endian(i) for i in byte_ids]
        self.raw_unknown = little_endian(sp.unk_id())
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in ids)
        self.automaton = ahocorasick.Automaton()
        reachable = {p for p in ids if len(self.merge(p)) == 1}
        self.shorter: dict[str, str] = {}
        for piece in reachable:
            self.automaton.add_word(piece, len(piece))
            for length in range(len(piece) - 1, 0, -1):
                if piece[:length] in reachable:
                    self.shorter[piece] = piece[:length]
                    break
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units = _Units(self.encode_unit)

    def merge(self, text: str) -> list[str]:
        """Plain merging, for strings of a few pieces."""
        symbols, scores = list(text), self.scores
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def pieces(self, unit: str) -> list[str]:
        """The unit's segmentation, by backtracking."""
        n, shorter = len(unit), self.shorter
        # matches come by ascending end, so the last one kept for a start is the longest
        longest = {last - length + 1: length for last, length in self.automaton.iter(unit)}
        failed = bytearray(n // 8 + 1)
        taken: list[str] = []
        before, at = None, 0
        piece = unit[:longest.get(0, 1)]  # a character outside the vocabulary stands alone
        while at < n:
            while piece is not None:
                to = at + len(piece)
                if not failed[to >> 3] >> (to & 7) & 1 and (before is None or self.compatible(before, piece)):
                    break
                # the next shorter piece that starts here; at last the single character
                piece = shorter.get(piece) or (piece[0] if len(piece) > 1 else None)
            if piece is not None:
                taken.append(piece)
                before, at = piece, to
                piece = unit[at:at + longest.get(at, 1)]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if before is None:
                    raise ValueError("no segmentation: the model is not of the merge type")
                last = taken.pop()
                at -= len(last)
                before = taken[-1] if taken else None
                piece = shorter.get(last) or (last[0] if len(last) > 1 else None)
        return taken

    def encode_unit(self, unit: str) -> bytes:
        out: list[bytes] = []
        for piece in self.pieces(unit):
            known = self.raw.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte_fallback:
                out.extend(self.raw_bytes[b] for b in piece.encode("utf-8"))
            elif not out or out[-1] != self.raw_unknown:
                out.append(self.raw_unknown)
        return b"".join(out)

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a whole text without begin and end, as little-endian unsigned 32-bit."""
        marked = self.library.normalize(text) if text else ""
        if not marked:
            return b""
        if not self.cuts or marked[0] != SPACE:
            return self.encode_unit(marked)
        if SPACE + SPACE not in marked and marked[-1] != SPACE:
            return b"".join(map(self.units.__getitem__, marked[1:].split(SPACE)))
        return b"".join(self.units[u[1:]] for u in re.findall(f"{SPACE}+[^{SPACE}]*", marked))

    def encode(self, text: str | None) -> list[int]:
        """Ids with begin and end."""
        ids = np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()
        return [self.begin, *ids, self.end]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One codec per worker process."""
    return PieceCodec(model_file)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", with_ids: bool = True,
                     kept: list[str] | None = None) -> DataFrame:
    """Per document: token count and digests of ids and decoded text; ``with_ids`` adds the
    ids themselves (begin and end included), else they never leave the task. The columns
    ``kept`` come last, as they are."""
    kept = kept or []
    given = docs.select("doc_id", F.col(f"`{text}`").alias("text"), *kept)
    types = {f.name: f.type for f in to_arrow_schema(given.schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_file)
        begin, end = little_endian(c.begin), little_endian(c.end)
        for cols in sliced(batches):
            raws = [begin + c.encode_bytes(t) + end for t in cols["text"]]
            counts = [len(raw) // 4 for raw in raws]
            decoded = (c.decode(np.frombuffer(raw, dtype="<u4").tolist()) for raw in raws)
            out = {"doc_id": pa.array(cols["doc_id"], pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
                   "ids_sha256": pa.array([hashlib.sha256(raw).hexdigest() for raw in raws]),
                   "decoded_sha256": pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded])}
            if with_ids:
                values = np.frombuffer(b"".join(raws), dtype="<i4")
                out["ids"] = pa.ListArray.from_arrays(np.cumsum([0, *counts]).astype(np.int32), values)
            out.update({c: pa.array(cols[c], types[c]) for c in kept})
            yield pa.RecordBatch.from_pydict(out)

    schema = T.StructType.fromDDL(DIGEST_SCHEMA + (", ids array<int>" if with_ids else ""))
    return given.mapInArrow(run, T.StructType([*schema.fields, *(given.schema[c] for c in kept)]))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_documents(docs, default_model(), with_ids=False)
