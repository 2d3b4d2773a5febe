"""Operator 5: token ids in Arrow stream files of equal-length sequences.

Documents are tokenized, closed with an end id and laid one after another, in ascending
``doc_id``, into sequences of ``sequence_length`` ids. A file is an Arrow IPC stream whose
record batches all hold ``batch_rows`` sequences as two fixed-size lists: ``ids`` and
``mask`` (true: an id, false: padding at the file's end). No column has nulls and every
batch has the same byte length, so batch *k* starts at ``header + k * batch_bytes``: a
memory-mapped file gives any sequence without copying or reading what lies before it.

Range partitions of ``doc_id`` are written by one task each, to files named by attempt; the
manifest (a written table, one row per document) names the file of the attempt that
succeeded, so a retried task leaves at most a file that nothing refers to.

Defined results: a NULL or empty text is one end id; repeated ``doc_id`` values are kept,
ordered by text; NULL ``doc_id`` values come first; an empty table gives no files and no
rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlegap.llm.common import read_table, scratch_dir, shared_filesystem, sliced, spread, written

SEQUENCE_LENGTH = 1024
BATCH_ROWS = 64
END_ID = 1
#: Distinct words that one worker remembers before it starts afresh.
CACHE_WORDS = 1_000_000
#: Small Latin letters: precomposed, so that the vocabulary's normalizer leaves them as they are.
_SMALL = "a-z" + "".join(chr(c) for c in range(0xDF, 0x180) if chr(c).islower())
_PLAIN = re.compile(f"[!-@\\[-~{_SMALL}]+")
#: Fixed value: the vocabulary's pre-tokenizer pattern, for words of such characters.
_UNITS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_SMALL}]+|[0-9]|[^{_SMALL}0-9]+")
#: The character that stands for each byte in the vocabulary: itself where it can be seen in
#: Latin-1, the others from 256 on.
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _SEEN]
_BYTE_CHARS = [chr(b) if b in _SEEN else chr(256 + _HIDDEN.index(b)) for b in range(256)]
MANIFEST_SCHEMA = "part int, file string, doc_id long, local_start long, n_tokens long"


class WordTokenizer:
    """The library's ids of whole texts, looked up word by word.

    The vocabulary's normalizer turns white space into one space, lower-cases, and its
    pre-tokenizer drops spaces, so no token crosses a space, tab or newline.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.model = self.library.model
        size = np.dtype(self.dtype).itemsize
        self.packed = [i.to_bytes(size, "little") for i in range(self.library.get_vocab_size())]
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian integers of ``dtype``."""
        raw = (text or "").encode("utf-8")
        if b"<|" not in raw:  # else a special token's name may stand there, and case counts
            raw = raw.lower()  # A-Z only
        words = raw.replace(b"\n", b" ").replace(b"\t", b" ").split(b" ")
        known = self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > CACHE_WORDS // 2:  # words in use come back from the older half
                self.older, self.words = known, {}
                known = self.words
            self.learn([w for w in set(words) if w not in known])
            return b"".join([known[w] for w in words])

    def unit(self, unit: str) -> bytes:
        """Ids of one unit of the pre-tokenizer, which is a word of its own as well."""
        raw = unit.encode("utf-8")
        found = self.words.get(raw) or self.older.get(raw)
        if found is None:
            packed, mapped = self.packed, unit if unit.isascii() else "".join([_BYTE_CHARS[b] for b in raw])
            found = b"".join([packed[t.id] for t in self.model.tokenize(mapped)])
        self.words[raw] = found
        return found

    def learn(self, words: list[bytes]) -> None:
        plain, others = [], []
        for word in words:
            found = self.older.get(word)
            if found is not None:
                self.words[word] = found
            else:
                value = word.decode("utf-8")
                if _PLAIN.fullmatch(value) and "<|" not in value:
                    self.words[word] = b"".join([self.unit(u) for u in _UNITS.findall(value)])
                    continue
                (plain if value.isalpha() else others).append((word, value))
        # words of letters only are one unit of the pre-tokenizer each: one call for many
        for at in range(0, len(plain), 4096):
            part = plain[at:at + 4096]
            e = self.library.encode(" ".join(v for _, v in part), add_special_tokens=False)
            raw, size = np.asarray(e.ids, dtype=self.dtype).tobytes(), np.dtype(self.dtype).itemsize
            units = np.asarray(e.word_ids, dtype=np.int64)
            if len(units) == 0 or units[-1] != len(part) - 1:  # should a letter count as none there
                others += part
                continue
            bounds = (np.searchsorted(units, np.arange(len(part) + 1)) * size).tolist()
            for k, (word, _) in enumerate(part):
                self.words[word] = raw[bounds[k]:bounds[k + 1]]
        encoded = self.library.encode_batch_fast([v for _, v in others], add_special_tokens=False)
        for (word, _), e in zip(others, encoded, strict=True):
            self.words[word] = np.asarray(e.ids, dtype=self.dtype).tobytes()


@functools.lru_cache(maxsize=2)
def tokenizer(tokenizer_file: str) -> WordTokenizer:
    return WordTokenizer(tokenizer_file)


class SequenceWriter:
    """Writes ids into one stream file."""

    def __init__(self, stream, dtype: str, length: int, rows: int):
        self.dtype, self.length, self.rows = np.dtype(dtype), length, rows
        self.schema = pa.schema([
            pa.field("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(self.dtype), False), length), False),
            pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False)])
        self.stream = stream
        self.writer = pa.ipc.new_stream(stream, self.schema)
        self.pending, self.held, self.total = [], 0, 0

    def add(self, raw: bytes) -> None:
        self.pending.append(raw)
        self.held += len(raw)
        self.total += len(raw) // self.dtype.itemsize
        full = self.length * self.rows * self.dtype.itemsize
        if self.held >= full:
            data = b"".join(self.pending)
            whole = len(data) // full * full
            for at in range(0, whole, full):
                self._batch(data[at:at + full])
            self.pending, self.held = [data[whole:]], len(data) - whole

    def _batch(self, data: bytes) -> None:
        cells = self.length * self.rows
        ids = np.zeros(cells, self.dtype)
        real = np.frombuffer(data, self.dtype)
        ids[:len(real)] = real
        mask = np.arange(cells) < len(real)
        fields = [self.schema.field(i).type for i in (0, 1)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(v), type=t) for v, t in zip((ids, mask), fields, strict=True)],
            schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._batch(b"".join(self.pending))
        self.writer.close()
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of one stream file (zero-copy where memory-mapped)."""

    def __init__(self, path: str):
        local = path.removeprefix("file:") if path.startswith("file:") else path
        if "://" not in local:
            self.source = pa.memory_map("/" + local.lstrip("/"))
        else:
            fs, inner = shared_filesystem(path)
            self.source = fs.open_input_file(inner)
        self.schema = pa.ipc.read_schema(self.source)
        self.header = self.source.tell()
        self.length = self.schema.field("ids").type.list_size
        first = pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
        self.rows, self.batch_bytes = first.num_rows, self.source.tell() - self.header

    def batch(self, k: int) -> pa.RecordBatch:
        self.source.seek(self.header + k * self.batch_bytes)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def sequence(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of the n-th sequence."""
        b, at = self.batch(n // self.rows), n % self.rows * self.length
        ids = b.column(0).values.to_numpy(zero_copy_only=True)[at:at + self.length]
        return ids, b.column(1).values.slice(at, self.length).to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the file."""
        cells, out = self.rows * self.length, []
        while n > 0:
            k, at = divmod(start, cells)
            b = self.batch(k)
            take = min(n, cells - at)
            mask = b.column(1).values.slice(at, take)
            if mask.true_count != take:
                raise ValueError("ids beyond the end of the file")
            out.append(b.column(0).values.to_numpy(zero_copy_only=True)[at:at + take])
            start, n = start + take, n - take
        return np.concatenate(out) if out else np.empty(0, np.uint16)


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = END_ID,
                      sequence_length: int = SEQUENCE_LENGTH, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Writes the files; returns the manifest: one row per document, with the range
    partition, file, first position in the file and number of ids (end id included)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(tokenizer_file)
        end = np.asarray([end_id], dtype=t.dtype).tobytes()
        part, writer, file = TaskContext.get().partitionId(), None, None
        for cols in sliced(batches):
            if writer is None:
                fs, inner = shared_filesystem(folder)
                fs.create_dir(inner, recursive=True)
                file = f"part-{part:06d}-{uuid.uuid4().hex}.arrows"
                writer = SequenceWriter(fs.open_output_stream(f"{inner}/{file}"), t.dtype, sequence_length, batch_rows)
            starts, counts = [], []
            for text in cols["text"]:
                starts.append(writer.total)
                writer.add(t.encode(text) + end)
                counts.append(writer.total - starts[-1])
            n = len(starts)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * n, pa.int32()), "file": pa.array([file] * n, pa.string()),
                "doc_id": pa.array(cols["doc_id"], pa.int64()), "local_start": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64())})
        if writer is not None:
            writer.close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(run, MANIFEST_SCHEMA), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files' contents."""
    files = manifest.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # one row per file
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = files.select("part", before.alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, opened = None, None
        for cols in sliced(batches, 4096):
            crcs = []
            for file, start, n in zip(cols["file"], cols["local_start"], cols["n_tokens"], strict=True):
                if file != name:
                    name, opened = file, SequenceFile(f"{folder}/{file}")
                crcs.append(zlib.crc32(opened.ids(start, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(cols["part"], pa.int32()), "doc_id": pa.array(cols["doc_id"], pa.int64()),
                "local_start": pa.array(cols["local_start"], pa.int64()),
                "n_tokens": pa.array(cols["n_tokens"], pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})

    read = (spread(manifest, "file").sortWithinPartitions("file", "local_start")
            .mapInArrow(run, "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long"))
    return read.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return read_token_files(write_token_files(docs, folder, default_tokenizer()), folder)
