"""Operators 2, 3, 4, 6, 7, the components and the pipeline."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import random
import re
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from candlegap.llm import ann, html_text, mixing, ngram_join, warc
from candlegap.llm.ann import nearest
from candlegap.llm.common import read_table, scratch_dir
from candlegap.llm.components import connected_components
from candlegap.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def brute_components(docs):
    sets = []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((doc_id, {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), len(s), str(least.get(root(i)))) for i, (d, s) in enumerate(sets))


def test_components_equal_brute_force(spark, edge_documents):
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 300)) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(160):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"new{i}"
        rows.append((i, " ".join(words)))
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), edge_documents,
                 read_table(spark, SF, "documents")):
        found = ngram_join.jaccard_components(docs).collect()
        got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
        assert got == brute_components([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_one_document_of_each_group(edge_documents, no_documents):
    kept = ngram_join.one_of_each(edge_documents)
    assert kept.columns == edge_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "None"])
    assert ngram_join.one_of_each(no_documents).count() == 0


def test_one_document_of_groups_without_distinct_ids(spark):
    base = [f"w{i}" for i in range(60)]
    for doc_id in (7, None):  # near copies under one id, and under none
        rows = [(doc_id, " ".join([*base, f"end{i}"])) for i in range(4)] + [(9, "another text that has nothing to do with it")]
        kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted(str(r["doc_id"]) for r in kept) == sorted([str(doc_id), "9"])


def test_frequent_list_does_not_change_links(spark, monkeypatch):
    docs = read_table(spark, SF, "documents")
    want = sorted(map(str, ngram_join.jaccard_components(docs).select("doc_id", "component_id").collect()))
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "STARS", 1)
    assert sorted(map(str, ngram_join.jaccard_components(docs).select("doc_id", "component_id").collect())) == want


def _prefix_step(spark, docs):
    frequent = spark.sparkContext.broadcast(ngram_join.frequent_shingles(docs))
    return frequent, ngram_join.classes_of(ngram_join.described(docs, frequent))


def test_a_large_bucket_has_several_leaders(spark):
    low = list(range(1, ngram_join.LOW + 1))  # 200 sets whose least hashes are the same
    rows = [(i, i.to_bytes(16, "big"), i, 100, i.to_bytes(16, "big"), low, [0] * ngram_join.PARITY_LONGS) for i in range(200)]
    classes = spark.createDataFrame(
        rows, "cid long, sig binary, rep long, n int, grp binary, low array<long>, parity array<long>")
    pairs = [tuple(r) for r in ngram_join.star_pairs(classes).collect()]
    degree = collections.Counter(x for pair in pairs for x in pair)
    leaders = [x for x, n in degree.items() if n == 199]
    assert 5 <= len(leaders) <= ngram_join.LEADERS and len(pairs) < 200 * ngram_join.LEADERS  # linear in the bucket


def test_one_exchange_serves_both_sides_of_the_token_join(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents", "doc_id", "text")
    frequent, classes = _prefix_step(spark, docs)
    roots = ngram_join.connected_components(ngram_join.verified(docs, classes, ngram_join.star_pairs(classes)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = ngram_join.candidate_pairs(docs, frequent, classes, roots)
        node = pairs._jdf.queryExecution().sparkPlan()
        joins, todo = [], [node]
        while todo:
            n = todo.pop()
            todo += [n.children().apply(i) for i in range(n.children().size())]
            if "Join" in n.nodeName() and n.simpleString(200).startswith("SortMergeJoin [token"):
                joins.append(n)
        assert len(joins) == 1 and joins[0].children().apply(0).sameResult(joins[0].children().apply(1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_connected_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    rnd.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_pages_text(spark):
    rows = [(None, None, None), (1, "http://a.b/x", "<p>a"), (2, "//a.b/x", "no tags &amp; <b>x</b>\n\ny"),
            (3, "x", "<body><header>h</header><article><h1>T</h1><div class='comments'>c</div><p>t &lt;3<br>u</article><p>z"),
            (4, "x", "<" * 500), (5, "x", ""), (5, "x", ""), (6, "y", "<script>var a='<p>'</script><article>q<style>p</style></article>"),
            (7, "y", "<article><p class=\"lead>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text")
    got = collections.defaultdict(list)
    for r in html_text.main_text(pages).collect():
        got[r["page_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert got[None] == [""] and got[1] == ["a"] and got[2] == ["no tags & x y"] and got[3] == ["T\nt <3 u"]
    assert got[5] == ["", ""] and got[6] == ["q"] and got[4] == ["<" * 500]
    assert html_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("html, want", [
    ('<article><p>a <a href="/hidden-gems">b</a> <i style="overflow:hidden">c</i></p></article>', ["a b c"]),
    ('<article><p>a</p><div data-id="menu">b</div><p><a href="/view?id=comment-5">c</a></p></article>', ["a", "b", "c"]),
    ('<body class="has-sidebar"><div class="content-with-sidebar"><article><p>a</p></article></div><p>x', ["a"]),
    ('<body class="sidebar"><p>a</p><div class="sidebar">x</div>', ["a"]),
    ('<div>skip</div><form action="/"><div class="menu">x</div><article><p>a b c</p></article></form>', ["a b c"]),
    ('<p>skip</p><form action="/"><div class="menu">x</div><p>a b c</p></form>', ["skip", "a b c"]),
    ('<div class="widget"><main><p>a b</p><div class="comments">x</div></main></div>', ["a b"]),
    ('<p>the text of the page</p><div class="related"><article>x</article></div>', ["the text of the page"]),
    ('<article><p class="notice">x<p>a<p>b<ul><li class="ad">x<li>c</ul><dl><dt class="ad">x<dd>d</dl>'
     '<table><tr><td class="ad">x<td>e</table></article>', ["a", "b", "c", "d", "e"]),
    ('<aside><article>x</article></aside><p>a</p><form>x</form>', ["a"]),
    ('<article><div class="cookie-banner">x</div><div hidden>x</div><p aria-hidden="false">a</p></article>', ["a"]),
    # what closes itself, or at once, holds nothing of what follows
    ('<article><p>a <svg class="i"/> b</p><svg><text>x</text></svg><p>c <svg d="/>"/>d</p></article>', ["a b", "c d"]),
    ('<article><p>a <object data="x"/>b</p><p><object data="y">c</object></p></article>', ["a b", "c"]),
    ('<article><!--><p>a</p><!---><p>b</p><!-- x --!><p>c</p><!-- <p>x</p> --></article>', ["a", "b", "c"]),
    ('<article><script>x</script foo><p>a</p><style>x</style\n><p>b</p><script/>x</script><p>c</p></article>', ["a", "b", "c"]),
    ('<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>', ["so x=1 holds"]),
    # headings and their sections are the article's, whatever words their ids are made from
    ('<article><h2 id="discussion">Discussion</h2><section id="discussion"><p>a <a href="/">b</a></p></section>'
     '<h3 class="social">S</h3><section id="navigation">n</section></article>', ["Discussion", "a b", "S", "n"]),
    ('<article><p>a</p><section id="comments"><p>x</p><textarea>x</textarea></section><section class="comments">x</section>'
     '<div id="comments">x</div></article>', ["a"]),
    ('<p>a</p><section id="comments"><p>x</p></section>', ["a"]),
])
def test_markup_drops_what_it_names_and_no_more(html, want):
    assert html_text.blocks(html)[0] == want


def test_host_suffix_array_finds_what_pages_share(spark):
    shared = "home about us contact our team read all the news of this town every day"
    rows = [(i, "http://h.org/%d" % i, f"<div>{shared}</div><div>story {i} " + " ".join(f"w{i}x{k}" for k in range(20)) + "</div>")
            for i in range(6)]
    rows += [(10 + i, "http://copies.org", f"<div>{shared} {shared}</div>") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith(f"story {i} ") and shared not in got[i] for i in range(6))
    assert all(got[10 + i] == f"{shared} {shared}" for i in range(5))  # copies of one page
    tokens = np.array([3, 1, 2, 3, 1, 2, 9], np.int64)
    rank = html_text.suffix_ranks(tokens, 4)
    order = sorted(range(7), key=lambda i: tokens[i:i + 4].tolist())
    assert list(np.argsort(rank, kind="stable")) == order


def test_suffix_array_and_repeated_runs_equal_brute_force():
    rnd = random.Random(11)
    for size in (1, 2, 7, 120):
        tokens = np.array([rnd.randint(0, 3) for _ in range(size)] + [5] * (size // 4), np.int64)
        order, common = html_text.suffix_array(tokens)
        suffixes = [tokens[i:].tolist() for i in order]
        assert suffixes == sorted(suffixes) and sorted(order) == list(range(len(tokens))) and common[0] == 0
        for one, other, n in zip(suffixes, suffixes[1:], common[1:], strict=False):
            assert one[:n] == other[:n] and one[n:n + 1] != other[n:n + 1]
    long, runs = 4, [[f"r{k}x{i}" for i in range(n)] for k, n in enumerate((4, 9, 40))]
    pages = []
    for i in range(12):  # runs of several lengths, on more and on fewer pages, and twice on one
        words = []
        for k in rnd.choices(range(3), k=3):
            words += [f"p{i}w{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, 5))] + runs[k][rnd.randint(0, 2):]
        pages.append([" ".join(words[:7]), " ".join(words[7:])])
    grams = [[tuple(w[j:j + long]) for j in range(len(w) - long + 1)] for w in (" ".join(p).split(" ") for p in pages)]
    held = collections.Counter(g for of_page in grams for g in set(of_page))
    sums = collections.Counter()
    for part in (pages[:5], pages[5:6], pages[6:]):
        for key, n in zip(*html_text.substrings(part, "h", long), strict=True):
            sums[int(key)] += int(n)
    assert sorted(sums.values()) == sorted(held.values())
    shared = np.array([key for key, n in sums.items() if n >= html_text.PAGES], np.int64)
    for page, of_page in zip(pages, grams, strict=True):
        mask = np.zeros(sum(b.count(" ") + 1 for b in page), bool)
        for at, g in enumerate(of_page):
            mask[at:at + long] |= held[g] >= html_text.PAGES
        got, kept, place = html_text.unique_runs(page, "h", shared, long), [], 0
        for block in page:
            words = block.split(" ")
            inside = mask[place:place + len(words)]
            place += len(words)
            free = [at for at, hit in enumerate(inside) if not hit]
            if inside.mean() < html_text.COVERED:
                first = free[0] if free[0] >= long else 0
                last = free[-1] + 1 if len(words) - free[-1] - 1 >= long else len(words)
                kept.append(" ".join(words[first:last]))
        assert got == (page if mask.mean() >= html_text.COPY else kept)


def test_what_a_host_shares_does_not_depend_on_its_size(spark):
    shared = "home about us contact our team read all the news of this town every day"
    own = {i: f"story {i} " + " ".join(f"w{i}x{k}" for k in range(20)) for i in range(40)}
    rows = [(i, "http://h.org/%d" % i, (f"<div>{shared}</div>" if i % 13 == 0 else "") + f"<div>{text}</div>"
             + "<script>'<article>'</script>" * (i % 2)) for i, text in own.items()]  # a word of the mark marks nothing
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for host_pages in (1, 7, 256):
        assert {r["page_id"]: r["text"] for r in html_text.main_text(pages, host_pages).collect()} == own


def test_pages_of_the_table_equal_their_article(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in read_table(spark, SF, "pages").collect()}
    for r in QUERIES["op2_html_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", article))
        assert r["text"] == "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_archives_round_trip(spark):
    rows = [(1, None, "a" * 300_000), (1, None, "a" * 300_000), (None, "x y\n", None), (5, "u", "é" * 100_000),
            (6, "u", "é" * 100_000), (7, "u", "é" * 100_000), (8, "v", "short"), (9, "v", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS sha")
    folder = scratch_dir(spark, "test-warc")
    got = warc.read_archives(warc.write_archives(pages, folder), folder).collect()
    last = {}
    for page_id, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), page_id if page_id is not None else -1)
    want = []
    for page_id, _, h in rows:
        raw = (h or "").encode()
        other = page_id is not None and page_id != last[h or ""]
        want.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if other else "response", last[h or ""] if other else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    empty = scratch_dir(spark, "test-warc")
    assert warc.read_archives(warc.write_archives(pages.limit(0), empty), empty).count() == 0
    assert warc.dechunked(warc.chunked(b"x" * 20_000)) == b"x" * 20_000


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    folder = scratch_dir(spark, "test-warc")
    got = warc.read_archives(warc.write_archives(pages, folder, min_revisit_bytes=3), folder).collect()
    assert {r["record_type"] for r in got} == {"response"}


def test_neighbours_recall_and_edges(spark):
    vectors = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = nearest(vectors, vectors.where("vec_id % 20 = 0")).toPandas()
    given = vectors.toPandas()
    x, ids, hits = np.stack(given["embedding"]).astype(np.float64), given["vec_id"].to_numpy(), 0
    for query, found in rows.groupby("query_id"):
        score = x @ x[ids == query][0]
        score[ids == query] = -np.inf
        hits += len(set(ids[np.argsort(-score)[:20]]) & set(found["vec_id"]))
        assert list(found.sort_values("rank")["score"]) == sorted(found["score"], reverse=True) and len(found) == 20
    assert hits >= 0.9 * len(rows)
    odd = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
           (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.0])]
    table = spark.createDataFrame(odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard")
    got = nearest(table, table.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 2.0), (1, 1.0), (8, -1.0)]
    assert nearest(table.limit(0), table).count() == 0


def test_mixing_equals_its_sql_and_keeps_to_the_weights(spark):
    rows = QUERIES["op7_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    c = duckdb.connect()
    c.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = c.execute(ORACLE_SQL["op7_mixing"]).df()[list(rows.columns)]
    key = ["doc_id"]
    assert rows.sort_values(key).reset_index(drop=True).astype(str).equals(want.sort_values(key).reset_index(drop=True).astype(str))


def test_rows_that_repeat_a_query_id_are_queries_each(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [0.5, 0.4])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(table, table.where("vec_id = 0"), k=2).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r["vector"]].append((r["query_id"], r["rank"], r["vec_id"]))
    assert sorted(by.values()) == [[(0, 1, 1), (0, 2, 3)], [(0, 1, 2), (0, 2, 3)]]


def test_recall_over_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(ann, "QUERY_ROWS", 25)
    x = np.random.default_rng(2).standard_normal((2000, 16)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = nearest(table, table.where("vec_id % 20 = 0"), k=10).collect()
    exact, hits = x.astype(np.float64), 0
    for q in range(0, 2000, 20):
        score = (exact * exact[q]).sum(axis=1)
        score[q] = -np.inf
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(s == score[v] for _, v, s in mine)
        hits += len({m[1] for m in mine} & set(np.argsort(-score)[:10]))
    assert hits >= 900


def test_pages_without_id_revisit(spark):
    rows = [(None, "u", "same"), (1, "u", "same"), (4, "u", "same"), (4, "v", "same"), (None, "u", "own"), (None, "u", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_dir(spark, "test-warc")
    got = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"])
           for r in warc.read_archives(warc.write_archives(pages, folder), folder).collect()]
    assert sorted(got, key=str) == sorted([
        (None, "revisit", 4, 4), (1, "revisit", 4, 4), (4, "response", None, 4), (4, "response", None, 4),
        (None, "response", None, 3), (None, "response", None, 3)], key=str)


def test_given_pages_make_continuation_records(spark):
    """Some given pages are longer than a segment, and come back whole."""
    pages = read_table(spark, "/root/testdata/sf0.1", "pages")
    long = pages.where(F.octet_length("html") > warc.SEGMENT_BYTES)
    members = [m for r in long.collect() for m in warc.records_of(r["page_id"], r["url"], r["html"].encode(), None)]
    assert sum(b"continuation" in gzip.decompress(m)[:200] for m in members) >= long.count() > 0
    folder = scratch_dir(spark, "test-warc")
    got = warc.read_archives(warc.write_archives(long, folder), folder).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in got} == {
        r["page_id"]: (len(r["html"].encode()), warc.payload_digest(r["html"].encode())) for r in long.collect()}


def earliest_deadline_first(ws: list[int], slots: int) -> list[tuple[int, int]]:
    """(source, block) of each slot, by one run over all of them."""
    q, done, out = sum(ws), [0] * len(ws), []
    for t in range(slots):
        _, i = min((-((v + 1) * q // -w), i) for i, (v, w) in enumerate(zip(done, ws, strict=True)) if v * q // w <= t)
        out.append((i, done[i]))
        done[i] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 0.7, "b": 0.2, "c": 0.1}, {"a": 1, "b": 1, "c": 3}, {"a": 2, "b": 1}, None])
def test_less_than_one_block_from_the_weights(spark, weights):
    docs = spark.createDataFrame([(i, "aab"[i % 3] if i % 7 else "c") for i in range(900)], "doc_id long, source string")
    rows = mixing.place(docs, weights, block_docs=4).select("doc.source", "mix.*").toPandas()
    blocks = rows.drop_duplicates(["source", "block"]).sort_values("slot")
    inside = blocks[blocks["in_target"]]
    assert blocks["slot"].is_unique and ((inside["slot"] >= inside["release"]) & (inside["slot"] < inside["deadline"])).all()
    assert list(inside["slot"]) == list(range(len(inside))) and len(rows) == 900
    after = blocks[~blocks["in_target"]]
    assert after.sort_values(["deadline", "source"])["slot"].is_monotonic_increasing and (after["slot"] >= len(inside)).all()
    sizes = rows["source"].value_counts()
    target = weights or {s: round(1000 * n ** 0.5) for s, n in sizes.items()}
    target = {s: Fraction(str(target.get(s, min(target.values())))) for s in sizes.index}
    for s, w in target.items():
        share = w / sum(target.values())
        had = (inside["source"] == s).cumsum()
        assert all(abs(n - share * t) < 1 for t, n in enumerate(had, 1))
    short = {s: -(-n // 4) for s, n in sizes.items()}
    ws = list(mixing.integer_weights({s: float(target[s]) for s in sorted(target)}).values())
    want = earliest_deadline_first(ws, len(inside) + 1)
    names = sorted(target)
    assert [(names[i], j) for i, j in want[:-1]] == list(zip(inside["source"], inside["block"], strict=True))
    assert want[-1][1] == short[names[want[-1][0]]]  # the horizon: a block that its source lacks


@given(st.lists(st.integers(1, 40), min_size=1, max_size=9))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_ranges_scheduled_apart_are_one_schedule(spark, monkeypatch, ws):
    """Many short ranges, where most begins have spanning blocks, equal one run over all slots."""
    monkeypatch.setattr(mixing, "RANGE_SLOTS", 1)
    q, slots = sum(ws), 6 * (sum(ws) // min(ws) + 2)
    one = spark.range(1).select(
        F.array(*[F.struct(F.lit(f"s:{i}").alias("src"), F.lit(w).cast("long").alias("w"), F.lit(10 ** 6).cast("long").alias("blocks"))
                  for i, w in enumerate(ws)]).alias("sources"),
        F.lit(q).cast("long").alias("q"), F.lit(slots).cast("long").alias("h"), F.lit(q // min(ws) + 2).cast("long").alias("l"))
    got = mixing.schedule(one).orderBy("slot").collect()
    assert [r["slot"] for r in got] == list(range(slots))
    assert [(int(r["src"][2:]), r["block"]) for r in got] == earliest_deadline_first(ws, slots)


def test_many_small_sources_keep_their_weights(spark):
    """One large source and a thousand of few documents: the large one has its share, which is a
    hundredth of the slots of one period and of no period of a thousand slots."""
    docs = spark.range(15_000).selectExpr("id AS doc_id", "if(id < 5000, 'large', concat('s', id % 1000)) AS source")
    rows = mixing.place(docs, block_docs=4).select("doc.source", "mix.*").toPandas()
    inside = rows[rows["in_target"]].drop_duplicates(["source", "block"]).sort_values("slot")
    assert list(inside["slot"]) == list(range(len(inside))) and len(inside) > 1000 and len(rows) == 15_000
    weight = {s: round(1000 * n ** 0.5) for s, n in rows["source"].value_counts().items()}
    q = sum(weight.values())
    for s in ("large", "s0", "s999"):
        had = (inside["source"] == s).cumsum()
        assert all(abs(n * q - weight[s] * t) < q for t, n in enumerate(had, 1))


def test_weights_are_exact():
    assert mixing.integer_weights({"a": 0.7, "b": 0.2, "c": 0.1, "d": 0}) == {"a": 7, "b": 2, "c": 1}
    assert mixing.integer_weights({"a": 0.0001, "b": 0.9999}) == {"a": 1, "b": 9999}
    for bad in ({"a": -1}, {"a": float("nan")}, {"a": 0}, {"a": 1e-12, "b": 1}):
        with pytest.raises(ValueError):
            mixing.integer_weights(bad)


def test_mixing_edges(edge_documents, no_documents):
    mixed = mixing.mix(edge_documents)
    assert mixed.columns == edge_documents.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, edge_documents.collect()))
    assert mixing.mix(no_documents).count() == 0


def test_pipeline_returns_the_mix(spark):
    docs = read_table(spark, SF, "documents").where("length(text) < 3000").limit(60).select(corpus_pipeline.COLUMNS)
    rows = corpus_pipeline.encoding_stage(spark, docs, SF).toPandas()
    want = mixing.place(docs).select("doc.doc_id", "mix.*").toPandas()
    columns = ["doc_id", *mixing.PLACED]
    assert sorted(map(str, rows[columns].values.tolist())) == sorted(map(str, want[columns].values.tolist()))
    assert not rows.duplicated(["slot", "within"]).any()


def test_pipeline_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard_join", "pii", "mixing", "sentencepiece"]
    docs = read_table(spark, SF, "documents")
    given = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows = corpus_pipeline.run(spark, SF).collect()
    words = {str(d) for d, t in given if any(ch.isalpha() for ch in t or "")}
    first = {c for _, n, c in brute_components([(d, t) for d, t in given if str(d) in words]) if n}
    assert {str(r["doc_id"]) for r in rows} == first and len(rows) == len(first)
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_pipeline_of_odd_tables(spark, tmp_path, edge_documents, no_documents):
    """NULLs, empty and long texts, repeated rows and a clashing extra column through all stages."""
    odd, none = str(tmp_path / "odd"), str(tmp_path / "none")
    edge_documents.write.parquet(f"{odd}/documents.parquet")
    rows = corpus_pipeline.run(spark, odd).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and {r["doc_id"] for r in rows} <= {1, 2, 6, 7, 8, None}
    assert len({1, 2} & {r["doc_id"] for r in rows}) <= 1  # equal texts: one stays
    assert not {3, 4, 5, 9} & {r["doc_id"] for r in rows}  # no text or no letter
    no_documents.write.parquet(f"{none}/documents.parquet")
    empty = corpus_pipeline.run(spark, none)
    assert empty.count() == 0 and empty.columns == corpus_pipeline.run(spark, odd).columns
