"""Operators 11, 12, 13 against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from candlegap.llm import fill_in_middle as fim
from candlegap.llm import merkle, quality
from candlegap.llm.common import read_table

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def run_of(level: list[str], i: int) -> tuple[str, str]:
    at = i // 8 * 8
    return "".join(level[at:i]), "".join(level[i + 1:at + 8])


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def path_of(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    return [run_of(level, i // 8 ** k) for k, level in enumerate(levels[:-1])]


def brute_manifest(rows: list[tuple]) -> list[tuple]:
    def leaf(values):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    groups: dict = {}
    for r in rows:
        later = list(r)
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            later[4] = r[4].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(later)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([x[2] for x in sorted(groups[g])]) for g in names]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for i, (known, doc_id, first, later) in enumerate(sorted(groups[g])):
            path, up = path_of(trees[k], i) + path_of(top, k), later
            for left, right in path:
                up = h(left, up, right)
            out.append((doc_id if known else None, first, trees[k][-1][0], top[-1][0],
                        h(*[a + b for a, b in path]), up, up == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)


def given_rows(df) -> list[tuple]:
    return [tuple(r) for r in df.select(*merkle.FIELDS).collect()]


def test_manifest_of_odd_rows(spark, edge_documents, no_documents):
    got = manifest_rows(edge_documents)
    assert got == brute_manifest(given_rows(edge_documents)) and len(got) == edge_documents.count()
    assert manifest_rows(no_documents) == []
    lone = edge_documents.where("doc_id = 7")
    (row,) = manifest_rows(lone)
    assert row == brute_manifest(given_rows(lone))[0]
    assert row[1] == row[2] == row[3] and row[4] == h() and row[6]


def test_manifest_of_the_table(spark):
    docs = read_table(spark, SF, "documents", *merkle.FIELDS)
    got = manifest_rows(docs)
    assert got == brute_manifest(given_rows(docs))
    assert 0 < sum(not r[6] for r in got) < len(got)


@pytest.mark.parametrize("rows", [8, 9, 64, 65, 530])
def test_manifest_over_several_climbs(spark, monkeypatch, rows):
    # chunks of one level, so every level is a climb of its own; one group holds most rows, and
    # equal rows come in hundreds
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "_CHUNK", merkle.FANOUT)
    made = [(k // 3 if k % 5 else 4, None, None if k % 7 == 3 else f"l{k % 2 * (k % 11)}", k % 4, "Text") for k in range(rows)]
    df = spark.createDataFrame(made, DOCS).repartition(3)
    assert manifest_rows(df) == brute_manifest(made)


# -- fill in the middle --------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_infill(doc_id, text, units) -> tuple[int, str, str]:
    key = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(key[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else (n, "psm", f"<P>{p}<S>{s}<M>{m}")


def made_texts() -> list[str]:
    rnd = random.Random(7)
    parts = ["a", " ", "\n", "é😀", "<", "<S", "<P>", "<M", "\x0b", "\x85 ", "b c ", "\0", " "]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(2000)]
    return [*made, "", " ", "x", "word " * 150_000, "\t" * 3000]


@pytest.mark.parametrize("unit, split", [
    ("words", UNITS.findall), ("characters", list), ("lines", lambda t: re.findall(r"[^\n]*\n|[^\n]+", t))])
def test_infill_is_cut_as_by_plain_lists(unit, split):
    texts = made_texts()
    ids = list(range(len(texts)))
    forms = Counter()
    for doc_id, text, x in zip(ids, texts, fim.infill(ids, texts, unit), strict=True):
        assert (x.units, x.form, x.output) == brute_infill(doc_id, text, split(text))
        assert fim.restored(x.output, x.form) == text
        forms[x.form] += 1
    assert set(forms) == {"plain", "spm", "psm"}


def test_wavelet_matrix_ranks_and_selects():
    symbols = np.random.default_rng(3).integers(0, 8, 1000).astype(np.uint8)
    matrix = fim.WaveletMatrix(symbols)
    places = np.arange(len(symbols) + 1)
    for s in range(8):
        assert matrix.rank(s, places).tolist() == [0, *np.cumsum(symbols == s).tolist()]
    wanted = np.flatnonzero(np.isin(symbols, (1, 6))) + 1
    found = matrix.select((1, 6), np.zeros(len(wanted), np.int64), np.full(len(wanted), 1000), np.arange(1, len(wanted) + 1))
    assert found.tolist() == wanted.tolist()


def test_infilled_documents(spark, edge_documents, no_documents):
    df = edge_documents.unionByName(read_table(spark, SMALL, "documents"), allowMissingColumns=True)
    want = []
    for r in df.collect():
        text = r["text"] or ""
        n, form, output = brute_infill(r["doc_id"], text, UNITS.findall(text))
        want.append((r["doc_id"], n, form, h(output), h(text)))
    got = fim.fill_in_middle(df, digests=True)
    key = {"key": str}
    assert sorted(((r["doc_id"], r["n"], r["form"], r["output_sha256"], r["restored_sha256"]) for r in got.collect()), **key) == \
        sorted(want, **key)
    for r in fim.fill_in_middle(df).collect():
        assert (r["prefix_chars"] is None) == (r["form"] == "plain")
        if r["form"] == "psm":
            assert r["output"][3 + r["prefix_chars"]:][:3] == "<S>"
    assert fim.fill_in_middle(no_documents).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(df, unit="pages")


# -- quality rules -------------------------------------------------------------

def brute_counts(text: str) -> tuple[int, ...]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {k + d for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside))


def test_base_counts(spark, edge_documents, no_documents):
    rnd = random.Random(5)
    parts = ["a ", "b ", "\n", "a b c", " #|é", "\r", "\x85", "\x0bx", "\0 "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    given = [t or "" for t in [*texts, *[r["text"] for r in edge_documents.collect()],
                               *[r["text"] for r in read_table(spark, SMALL, "documents").collect()]]]
    for t in given:
        assert quality.counts(t)[:5] == brute_counts(t)
    judged = quality.judged(edge_documents).collect()
    assert len(judged) == edge_documents.count()
    for r in judged:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.judged(no_documents).count() == 0


def test_estimated_accuracies_follow_the_votes():
    rnd = np.random.default_rng(11)
    good = rnd.random(40_000) < 0.8
    fire = [0.9, 0.7, 0.6, 0.02]   # how often each rule votes against a bad text
    votes = np.ones((len(good), 4), np.int64)
    for r, p in enumerate(fire):
        votes[~good & (rnd.random(len(good)) < p), r] = -1
        votes[good & (rnd.random(len(good)) < 0.02), r] = -1
    patterns, met = np.unique(votes, axis=0, return_counts=True)
    model = quality.VoteModel.fit(patterns, met)
    assert abs(model.share - 0.8) < 0.03
    assert np.abs(model.votes[1, :3, 2] - fire[:3]).max() < 0.08
    accuracy = model.accuracy()
    assert accuracy[0] > accuracy[1] > accuracy[2] > accuracy[3]
    kept = model.posterior(votes) >= 0.5
    assert (kept == good).mean() > 0.95
    # shares decide, not sizes
    again = quality.VoteModel.fit(patterns, met * 1000)
    assert np.allclose(again.votes, model.votes) and np.isclose(again.share, model.share)


def test_posterior_columns_equal_the_model(spark):
    counted = quality.count_documents(read_table(spark, SF, "documents", "doc_id", "text")).cache()
    model = quality.learn(counted)
    rows = counted.select("doc_id", *quality._votes(), quality.posterior(model).alias("p")).collect()
    votes = np.array([r[1:-1] for r in rows])
    assert np.allclose(model.posterior(votes), [r["p"] for r in rows])
    counted.unpersist()


def test_junk_goes_and_clean_texts_stay(spark):
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}
    rows = [r for r in quality.op13_quality(spark, SF).collect() if not r["base_failed"] and r["doc_id"] in labels]
    clean = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    junk = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(clean) > 0.99 and np.mean(junk) < 0.05
