"""Operators 1, 5, 8, 9, 10 against the libraries, brute force and held-out labels."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlegap.llm import fingerprints as fp
from candlegap.llm import language_id, pii, shingles
from candlegap.llm.common import read_table, scratch_dir
from candlegap.llm.sentencepiece_codec import PieceCodec, default_model, encode_documents
from candlegap.llm.token_files import (
    SequenceFile,
    WordTokenizer,
    default_tokenizer,
    read_token_files,
    write_token_files,
)

SF = "/root/testdata/sf0.001"


def texts_of(df):
    return [r["text"] for r in df.select("text").collect()]


@pytest.fixture(scope="module")
def piece_codec():
    return PieceCodec(default_model())


def test_pieces_equal_the_library(spark, piece_codec, edge_documents):
    rnd = random.Random(1)
    alphabet = ["abc ABC.,'\n\t  ", "▁ é́ß😀中 \u0000", "    ", "thereinging of "]
    made = ["".join(rnd.choice(rnd.choice(alphabet)) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    made += [" " * 3000, "a" * 3000, "ab" * 3000, "x" + " " * 37 + "y"]
    given = [t for t in texts_of(read_table(spark, SF, "documents")) + texts_of(edge_documents) if t is not None]
    for text in made + given:
        assert piece_codec.encode(text) == piece_codec.library.encode(text, add_bos=True, add_eos=True)


def test_encoded_documents(spark, piece_codec, edge_documents, no_documents):
    rows = encode_documents(edge_documents, default_model()).collect()
    assert len(rows) == edge_documents.count()
    want = {(r["doc_id"], tuple(piece_codec.library.encode(r["text"] or "", add_bos=True, add_eos=True)))
            for r in edge_documents.collect()}
    assert {(r["doc_id"], tuple(r["ids"])) for r in rows} == want
    for r in rows:
        raw = np.array(r["ids"], "<u4").tobytes()
        decoded = piece_codec.library.decode(r["ids"])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(r["ids"]), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert encode_documents(no_documents, default_model()).count() == 0


def test_word_ids_equal_the_library(spark):
    t = WordTokenizer(default_tokenizer())
    rnd = random.Random(2)
    alphabet = ["abc dEF's,.\n\t\r ", "ΣσςİıﬁÅǺ K \x1c\x85 ", "<|endoftext|> ", "12 '!re'LL", "ªº ʰǅⅣ٣中ａ"]
    made = ["".join(rnd.choice(rnd.choice(alphabet)) for _ in range(rnd.randint(0, 50))) for _ in range(4000)]
    for text in [*made, "a<|endoftext|>B", "<|ENDOFTEXT|>", ""]:
        assert np.frombuffer(t.encode(text), t.dtype).tolist() == t.library.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark, edge_documents, no_documents):
    folder = scratch_dir(spark, "test-tokens")
    manifest = write_token_files(edge_documents, folder, default_tokenizer(), sequence_length=64, batch_rows=4)
    rows = read_token_files(manifest, folder).orderBy("start").collect()
    library = WordTokenizer(default_tokenizer()).library
    docs = sorted(edge_documents.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    at = 0
    for doc, row in zip(docs, rows, strict=True):
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids + [1]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc["doc_id"], at, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    name = manifest.select("file").first()["file"]
    ids, mask = SequenceFile(f"{folder}/{name}").sequence(0)
    assert len(ids) == len(mask) == 64 and mask.dtype == bool
    empty = scratch_dir(spark, "test-tokens")
    assert read_token_files(write_token_files(no_documents, empty, default_tokenizer()), empty).count() == 0


def test_base_spans_on_long_runs():
    for text in ("a" * 10**5, "1" * 10**5, "a@" * 10**4, "+(" * 10**4, "1 " * 10**4, "1." * 10**4):
        pii.base_spans(text)
    assert pii.base_spans("a@b.c_d@e.f") == [(0, 0, 5), (5, 0, 11)]
    assert [s[1] for s in pii.base_spans("4111 1111 1111 1111, 10.0.0.255, 10.0.0.256, +1 (555) 010-9999")] == [2, 1, 3]


def test_personal_data_rows(edge_documents, no_documents):
    rows = pii.personal_data(edge_documents).collect()
    assert len(rows) == edge_documents.count() and {r["spans"] for r in rows} == {""}
    assert pii.personal_data(no_documents).count() == 0
    same = pii.sanitise(edge_documents)
    assert same.columns == edge_documents.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, edge_documents.collect()))


def test_terms_that_reveal_an_entity_are_removed(spark):
    rows = [(i, f"note {chr(97 + i) * 4} zyxclinic zyxward mail jo@x.org for {chr(98 + i) * 5} {chr(99 + i) * 6}") for i in range(6)]
    rows += [(100 + i, f"note about other mail and for thing {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    first = rows[0][1]
    assert f"term:{first.index('zyxclinic')}:" in found[0]["spans"] and found[0]["n_email"] == 1
    assert f"term:{first.index('note')}:" not in found[0]["spans"]
    assert all(found[100 + i]["spans"] == "" for i in range(60))
    text = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}[0]
    assert "zyxclinic" not in text and "[EMAIL]" in text and "note" in text


@pytest.mark.parametrize("others", [60, 600, 6000])
def test_one_document_is_no_evidence_at_any_size(spark, others):
    between = " ".join(["some text about this and that"] * 5)
    rows = [(0, f"zyxclinic here, {between}, mail jo@x.org, {between}, the ZyxClinic there")]
    rows += [(1 + i, f"ward {chr(97 + i) * 4} qvward mail al@x.org, {between} {chr(98 + i) * 5}") for i in range(6)]
    rows += [(10 + i, f"some text about this and that mail here the there ward, {between}") for i in range(others)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith("term")] for r in pii.personal_data(docs).collect()}
    for i in range(6):  # met in six documents and no other
        at = rows[1 + i][1].index("qvward")
        assert found[1 + i] == [f"term:{at}:{at + 6}"]
    assert not any(found[i] for i in found if not 1 <= i <= 6)


def test_terms_equal_the_definition(spark):
    """Random documents against counts and formulas in plain Python."""
    rng, rows = random.Random(5), []
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(120)]
    for i in range(240):
        who = rng.randrange(12) if i < 60 else None
        text = rng.sample(words, 12) + ([] if who is None else [f"u{who}@x.org", *[f"sign{chr(97 + who)}"] * (rng.random() < 0.9)])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.detect(docs, ["doc_id"])
    got = {(r["entity"], r["term"]): r["disclosure"] for r in pii.revealing_terms(
        pii.candidates(found, docs, len(rows), disclosure=0.5), len(rows), disclosure=0.5).collect()}
    n, held, having = len(rows), collections.defaultdict(list), collections.Counter()
    for _, text in rows:
        terms = {w for w in text.split() if "@" not in w}
        having.update(terms)
        for w in text.split():
            if "@" in w:
                held[pii._hash(f"0:{w}")].append(terms)
    want = {}
    for entity, documents in held.items():  # no two passages are equal here
        df, m = len(documents), sum(map(len, documents))
        ic = math.log2(n / df)
        for term in set().union(*documents):
            k, of = sum(term in d for d in documents), having[term]
            p, z2 = k / of, pii.Z ** 2
            low = (p + z2 / (2 * of) - pii.Z * math.sqrt(p * (1 - p) / of + z2 / (4 * of * of))) / (1 + z2 / of)
            tails = []
            for draws, chance in ((df, of / n), (of, df / n)):
                a = k / draws
                rest = (1 - a) * math.log((1 - a) / (1 - chance)) if a < 1 else 0
                tails.append(draws * (a * math.log(a / chance) + rest) if a > chance else 0)
            if k >= 2 and 1 + math.log2(low) / ic >= 0.5 and max(tails) >= math.log(m / pii.CHANCE):
                want[entity, term] = 1 + math.log2(p) / ic
    assert len(want) > 5 and got == pytest.approx(want)


def test_base_spans_equal_the_plain_patterns(spark):
    def plain(text):
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                  if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
            if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
                spans.append((m.start(), 2, m.end()))
        spans += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
        return sorted(spans)

    texts = [r["text"] for r in read_table(spark, "/root/testdata/sf0.01", "documents", "text").collect()]
    rng = random.Random(3)
    texts += ["".join(rng.choices("01239.+-@a () 4", k=60)) for _ in range(3000)]
    assert sum(len(plain(t or "")) for t in texts) > 50
    assert [pii.base_spans(t) for t in texts] == [plain(t or "") for t in texts]


def test_a_document_counts_once_however_often_it_repeats_an_entity(spark):
    # "common" stands beside the address in 40 different contexts of one document
    listed = " ".join(f"common {chr(97 + i % 26) * 3}{chr(97 + i // 26) * 4} mail jo@x.org" for i in range(40))
    rows = [(0, listed)] + [(i, f"{'common' if i < 30 else 'other'} words are here") for i in range(1, 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.detect(docs, ["doc_id"])
    near = pii.candidates(found, docs, 900, disclosure=0.1, least=1)
    counts = {r["term"]: (r["both"], r["disclosure"]) for r in pii.revealing_terms(near, 900, chance=1e9, disclosure=0.1, least=1).collect()}
    assert counts["common"][0] == 1 and counts["common"][1] == pytest.approx(math.log2(900 / 30) / math.log2(900))
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}[0].split(",")
    at = listed.index("common")
    assert f"term:{at}:{at + 6}" not in spans


def test_copies_reveal_nothing(spark):
    docs = spark.createDataFrame([(i, "rare words beside jo@x.org in one copied text") for i in range(9)], "doc_id long, text string")
    assert {r["spans"].count("term") for r in pii.personal_data(docs).collect()} == {0}


def test_fingerprints_follow_the_next_document(spark, edge_documents, no_documents):
    rows = fp.fingerprints(edge_documents).collect()
    docs = sorted(edge_documents.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    texts = [d["text"] or "" for d in docs]
    want = sorted((str(d["doc_id"]), hashlib.sha256(fp.edited(t, texts[(i + 1) % len(texts)]).encode()).hexdigest(), len(t))
                  for i, (d, t) in enumerate(zip(docs, texts, strict=True)))
    assert sorted((str(r["doc_id"]), r["edited_sha256"], r["n_chars"]) for r in rows) == want
    by_id = {}
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_id.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_id[1] == by_id[2] and by_id[3] == {""}
    assert fp.fingerprints(no_documents).count() == 0


def test_likeness_against_containment():
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(5000)}" for _ in range(3000)]
    long, errors = next(shingles.shingle_sets([" ".join(words)])), []
    for n in [5, 6, 8] * 8 + [24] * 40 + [200] * 10:  # short texts that the long one holds wholly
        at = rnd.randrange(2500)
        short = next(shingles.shingle_sets([" ".join(words[at:at + n])]))
        assert fp.compared(short, long) == fp.compared(long, short) == 1.0
        half = next(shingles.shingle_sets([" ".join(words[at:at + n] + [f"x{i}" for i in range(n)])]))
        if n == 24:
            assert len(fp.sketch(short)) >= 1
            errors.append(abs(fp.compared(half, long) - len(np.intersect1d(half, long)) / len(half)))
    assert np.mean(errors) < 0.2
    assert fp.compared(long[:0], long) == 0.0 and fp.compared(long[:0], long[:0]) == 1.0


def test_fingerprint_ranges_do_not_show(spark):
    docs = spark.createDataFrame([(i % 37 if i % 9 else None, f"text {i} of many words that go on for a while") for i in range(120)],
                                 "doc_id long, text string")
    found = []
    for n in ("1", "8", "64"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(str, fp.fingerprints(docs).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == 120


def test_sketches_merge():
    a, b = (next(shingles.shingle_sets([t])) for t in ("one two three four five six seven eight", "six seven eight nine ten eleven twelve"))
    joined = fp.sketch(np.union1d(a, b))
    assert np.array_equal(fp.merge(fp.sketch(a), fp.sketch(b)), joined)
    assert fp.likeness(joined, joined) == 1.0


def test_language_id_on_held_out_documents(spark, no_documents):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text", "lang")
    rows = language_id.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    nothing = language_id.learn(no_documents)
    assert nothing.predict(["text", None]) == (["und", "und"], [0.0, 0.0])


def test_language_id_of_odd_texts(edge_documents):
    filters = language_id.learn(edge_documents)
    got = {r["doc"]["doc_id"]: r for r in language_id.identify(edge_documents, filters, ["doc_id", "sig"]).collect()}
    assert {got[k]["lang_pred"] for k in (3, 4, 5, 9)} == {"und"} and got[7]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_rows_that_share_an_id_teach_a_language(spark):
    words = {"en": "the quick brown foxes were jumping over lazy sleeping dogs", "de": "zwischen schönen Häusern laufen viele kleine Kinder"}
    one, two = [k for k in range(30) if zlib.crc32(str(k).encode()) % 3 != 1][:2]  # not held out
    rows = [(one, words[lang] + f" {k}", lang) for k in range(60) for lang in words]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.learn(docs, train_docs=100).languages == ["de", "en"]
    few = language_id.learn(docs.unionByName(docs.withColumn("doc_id", F.lit(two).cast("long"))), train_docs=130)
    assert few.predict([words["en"], words["de"]])[0] == ["en", "de"]
