"""Operator 3: exact self-join on the Jaccard similarity of five-word shingle sets, and the
components of its links, by a grouped prefix join.

1. **Order.** Shingles are ordered by hash, after them the frequent ones by their count. Any
   one order makes the join exact; this one keeps frequent shingles out of prefixes. The list
   of frequent shingles is found from counts in each task, summed over all tasks, and holds at
   most ``FREQUENT`` shingles, so its broadcast is bounded.
2. **Classes.** Documents with equal sets are one class (128-bit digest of the set).
3. **Groups.** A class keeps its first ``n - ceil(0.8 n) + 1`` shingles as prefix: two sets with
   similarity 0.8 share a shingle of their prefixes. Classes with the same size and prefix
   are one group, and only groups are joined.
4. **Known links.** Stars over minimum hashes, verified on whole sets, link most near copies.
   Classes that are linked already need no further comparison, so a large group of near copies
   does not make all its pairs. This step may miss links; the next one finds the rest.
5. **Join.** Groups are joined on prefix shingles where their components differ, their sizes
   are within the bound and the places of the shared shingle leave room for the needed
   overlap; the number of shared shingles bounds the overlap of a pair once more. Pairs whose
   parity bitmaps differ in more bits than similar sets can differ in hashes are no links: a
   frequent shingle of a group of one carries the bitmap into the join, so many sets just
   below the threshold make no rows there. Group pairs are expanded to their members, compared
   by bitmap, and each pair left is verified on whole sets.

Whole sets are never shuffled for all documents: candidates' sets are made anew from the
texts that a bitmap of fixed size admits (a filter only: what it admits wrongly is dropped by
the join on the digest).

Defined results: NULL and empty texts and texts without words have an empty set and are
linked with nothing; rows with equal texts are linked, also rows that repeat a ``doc_id``; a
NULL ``doc_id`` is smaller than none; a document without any other is its own component; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlegap.llm.common import read_table, sliced, written
from candlegap.llm.components import connected_components
from candlegap.llm.shingles import shingle_sets

#: Frequent shingles known to all tasks: at most so many, each in at least so many documents.
FREQUENT = 1 << 20
FREQUENT_DOCS = 4
#: Hashes that a task holds before it counts them, and input splits that one task counts: a
#: shingle met once in a task is left out, so a task should meet many documents.
COUNTED_AT_ONCE, SPLITS_COUNTED = 2_000_000, 16
#: Least hashes kept of each set, how many of them name its buckets in step 4, and how many
#: leaders a bucket has.
LOW, STARS, LEADERS = 16, 8, 8
BITMAP_BITS = 1 << 23
#: Longs of a set's parity bitmap.
PARITY_LONGS = 8
#: Steps of the counts of shingles in one doubling; bounds the histogram that chooses the list.
STEPS = 8

#: Hashes in ascending order, and their ranks by frequency.
Frequent = tuple[np.ndarray, np.ndarray]


def prefix_length(n: int) -> int:
    """Shingles of which two sets with similarity 0.8 share at least one."""
    return n - (4 * n + 4) // 5 + 1


def frequent_shingles(docs: DataFrame) -> Frequent:
    """The frequent shingles, from counts of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seen = [], 0, set()

        def out():
            value, count = np.unique(np.concatenate(held), return_counts=True)
            value, count = value[count > 1], count[count > 1]
            return pa.RecordBatch.from_pydict({"h": pa.array(value.view(np.int64)), "n": pa.array(count.astype(np.int64))})

        for cols in sliced(batches):
            for s in shingle_sets(cols["text"]):
                digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                if digest in seen:  # copies count once
                    continue
                seen.add(digest)
                held.append(s)
                n += len(s)
                if n >= COUNTED_AT_ONCE:
                    yield out()
                    held, n, seen = [], 0, set()  # nothing outlives a count, so memory stays bounded
        if held:
            yield out()

    splits = docs.rdd.getNumPartitions()  # planned, not run
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, splits // SPLITS_COUNTED)
    counted = written(docs.select("text").coalesce(tasks).mapInArrow(run, "h long, n long").groupBy("h")
                      .agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_DOCS), "counts")
    step = F.floor(F.log2(F.col("n").cast("double")) * STEPS)
    first, total = 0, 0  # the most frequent steps that fit, each whole: at most 64 * STEPS rows to read
    for row in counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("shingles")).orderBy(F.desc("step")).collect():
        total += row["shingles"]
        if total > FREQUENT:
            first = row["step"] + 1
            break
    table = counted.where(step >= first).toArrow()  # at most FREQUENT rows, by Arrow: no row objects on the driver
    h, n = (table[c].to_numpy() for c in ("h", "n"))
    rank = np.empty(len(h), np.int32)
    rank[np.lexsort((h, -n))] = np.arange(len(h), 0, -1, dtype=np.int32)  # the most frequent one last
    h = h.view(np.uint64)
    order = np.argsort(h)
    return h[order], rank[order]


def _places(s: np.ndarray, frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """(place among the frequent shingles, whether it is one) of each shingle."""
    known = frequent[0]
    if not len(known):
        return np.zeros(len(s), np.int64), np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
    return at, known[at] == s


def in_order(s: np.ndarray, frequent: Frequent) -> np.ndarray:
    """A set (ascending) in the global order."""
    at, hot = _places(s, frequent)
    return np.concatenate([s[~hot], s[hot][np.argsort(frequent[1][at[hot]], kind="stable")]])


def prefix_of(s: np.ndarray, frequent: Frequent) -> np.ndarray:
    return in_order(s, frequent)[:prefix_length(len(s))]


def parity_bitmap(s: np.ndarray) -> np.ndarray:
    """Bit k tells whether the set has an odd number of hashes with place k. Two sets differ in
    at least as many hashes as their bitmaps differ in bits."""
    odd = np.bincount((s >> np.uint64(7)).astype(np.int64) % (64 * PARITY_LONGS), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


_ROWS = "doc_id long, sig binary, n int, grp binary, low array<long>, parity array<long>"


def described(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """One row per document: its set's digest, size, group (digest of size and prefix) and
    least hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches):
            sets = list(shingle_sets(cols["text"]))
            groups = [hashlib.blake2b(len(s).to_bytes(8, "little") + prefix_of(s, frequent.value).tobytes(),
                                      digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(cols["doc_id"], pa.int64()), "sig": pa.array([digest(s) for s in sets], pa.binary()),
                "n": pa.array([len(s) for s in sets], pa.int32()), "grp": pa.array(groups, pa.binary()),
                "low": pa.array([s[:LOW].view(np.int64) for s in sets], pa.list_(pa.int64())),
                "parity": pa.array([parity_bitmap(s) for s in sets], pa.list_(pa.int64()))})

    return docs.select("doc_id", "text").mapInArrow(run, _ROWS)


def prefixes(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """``sig, prefix`` of every distinct set, and the place of its first frequent shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches):
            sets = {digest(s): s for s in shingle_sets(cols["text"]) if len(s)}  # copies in a slice once
            firsts = [prefix_of(s, frequent.value) for s in sets.values()]
            yield pa.RecordBatch.from_pydict({
                "sig": pa.array(list(sets), pa.binary()),
                "prefix": pa.array([p.view(np.int64) for p in firsts], pa.list_(pa.int64())),
                "hot_at": pa.array([len(p) - np.count_nonzero(_places(p, frequent.value)[1]) for p in firsts],
                                   pa.int32())})

    # one of each by first(): over dropDuplicates Spark does not see that two uses are the same
    return (docs.select("text").mapInArrow(run, "sig binary, prefix array<long>, hot_at int").groupBy("sig")
            .agg(F.first("prefix").alias("prefix"), F.first("hot_at").alias("hot_at")))


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct set: a number ``cid``, and ``rep``, its least ``doc_id``."""
    kept = (rows.where("sig IS NOT NULL").groupBy("sig")
            .agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("grp").alias("grp"),
                 F.max(F.struct("low", "parity")).alias("l")))
    return written(kept.select(F.monotonically_increasing_id().alias("cid"), "sig", "rep", "n", "grp",
                               F.col("l.low").alias("low"), F.col("l.parity").alias("parity")), "classes")


def star_pairs(classes: DataFrame) -> DataFrame:
    """Likely pairs (a, b): the classes of each bucket with a few leaders of it, among them the
    one whose buckets are the largest, which is nearest to the middle of its near copies. The
    others are drawn, the likelier the larger their buckets: a leader at the rim of a large group
    links few of it, and every pair not linked here is a row of the join."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)))
    slim = classes.select("cid", band.alias("band"), F.explode(F.slice("low", 1, STARS)).alias("v"))
    sizes = slim.groupBy("v", "band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    known = written(slim.join(sizes, ["v", "band"]), "buckets")
    sought = known.join(known.groupBy("cid").agg(F.sum("size").alias("sought")), "cid")
    drawn = [F.col("sought") * (F.pmod(F.xxhash64("cid", F.lit(k)), F.lit(1000)) + 1) for k in range(1, LEADERS)]
    leaders = (sought.groupBy("v", "band").agg(F.array_distinct(F.array(*[
        F.max(F.struct(by, F.xxhash64("cid"), "cid"))["cid"] for by in (F.col("sought"), *drawn)])).alias("leaders"))
        .select("v", "band", F.explode("leaders").alias("a")))
    pairs = known.join(leaders, ["v", "band"]).select("a", F.col("cid").alias("b"))
    head = classes.groupBy("grp").agg(F.min("cid").alias("a"))
    in_group = classes.join(head, "grp").select("a", F.col("cid").alias("b"))
    pairs = pairs.unionByName(in_group).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # the least hashes of both sets estimate the similarity; links lost here are found by the join
    low = classes.select("cid", "low")
    both = (pairs.join(low.select(F.col("cid").alias("a"), F.col("low").alias("la")), "a")
            .join(low.select(F.col("cid").alias("b"), F.col("low").alias("lb")), "b"))
    least = F.slice(F.array_sort(F.array_union("la", "lb")), 1, LOW)
    shared = F.size(F.array_intersect(F.array_intersect(least, "la"), F.col("lb")))
    return both.where(shared * 5 >= F.size(least) * 2).select("a", "b")


def _needed(a: Column, b: Column) -> Column:
    """9 i >= 4 (n + m) for an overlap of i: the right side, for 9 times the left."""
    return F.lit(4) * (a + b)


def _may_link(a: str, b: str, sizes: Column) -> Column:
    """Whether two parity bitmaps differ in so few bits as similar sets of these sizes in sum
    can: with the needed overlap, sets differ in at most a ninth of that sum of hashes."""
    differ = F.lit(0)
    for k in range(PARITY_LONGS):
        differ = differ + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    return differ * 9 <= sizes


def candidate_pairs(docs: DataFrame, frequent: Broadcast, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of classes in different components that the prefixes do not exclude."""
    members = (classes.select("cid", "grp", "n").join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
               .select("cid", "grp", F.coalesce("root", "cid").alias("comp")))
    # one entry per group and prefix shingle; a group whose members are linked has their component
    groups = members.groupBy("grp").agg(F.min("cid").alias("gid"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                        F.count(F.lit(1)).alias("size"))
    heads = (classes.select("cid", "sig", "n", "parity").join(groups.select(
        F.col("gid").alias("cid"), F.when(F.col("c0") == F.col("c1"), F.col("c0")).otherwise(-1 - F.col("gid")).alias("comp"),
        "size"), "cid").withColumn("parity", F.when(F.col("size") == 1, F.col("parity"))))
    entries = (prefixes(docs, frequent).join(heads, "sig")
               .select(F.col("cid").alias("g"), "comp", "n", "parity", "hot_at", F.posexplode("prefix").alias("at", "token"))
               # size and place in one column: this is the largest exchange of the join, one for both sides
               .select("token", "g", "comp", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("at")).alias("n_at"),
                       F.when(F.col("at") >= F.col("hot_at"), F.col("parity")).alias("parity")))
    left, right = (entries.select("token", F.col("g").alias(f"g{k}"), F.col("comp").alias(f"comp{k}"),
                                  F.col("parity").alias(f"parity{k}"),
                                  F.shiftright("n_at", 32).alias(f"n{k}"),
                                  F.col("n_at").bitwiseAND(F.lit((1 << 32) - 1)).alias(f"at{k}")) for k in (1, 2))
    room = F.lit(9) * F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2"))
    need = _needed(F.col("n1"), F.col("n2"))
    shared = left.join(right, "token").where(
        (F.col("g1") < F.col("g2")) & (F.col("comp1") != F.col("comp2"))
        & (F.col("n1") * 5 >= F.col("n2") * 4) & (F.col("n2") * 5 >= F.col("n1") * 4) & (room >= need)
        & F.coalesce(_may_link("parity1", "parity2", F.col("n1") + F.col("n2")), F.lit(True)))
    pairs = (shared.groupBy("g1", "g2").agg(
        F.count(F.lit(1)).alias("c"), F.first("n1").alias("n1"), F.first("n2").alias("n2"),
        F.max("at1").alias("at1"), F.max("at2").alias("at2"))
        .where(F.lit(9) * (F.col("c") + F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2")) - 1)
               >= _needed(F.col("n1"), F.col("n2"))))
    named = members.join(groups.select("grp", "gid"), "grp").select("gid", "cid", "comp")
    one, two = (named.select(F.col("gid").alias(f"g{k}"), F.col("cid").alias(x), F.col("comp").alias(f"m{k}"))
                for k, x in ((1, "a"), (2, "b")))
    across = pairs.select("g1", "g2").join(one, "g1").join(two, "g2")
    # members of one group that are not linked yet
    mixed_groups = groups.where("c0 <> c1").select(F.col("gid").alias("g1"))
    within = (mixed_groups.join(one, "g1").join(two.withColumnRenamed("g2", "g1"), "g1").where("a < b")
              .withColumn("g2", F.col("g1")))
    return across.unionByName(within).where("m1 <> m2").select("a", "b").distinct()


def _bitmap(classes: DataFrame, cids: DataFrame) -> np.ndarray:
    """A bitmap of BITMAP_BITS bits over the ``rep`` of the given classes."""
    at = F.pmod(F.xxhash64("rep"), F.lit(BITMAP_BITS))
    words = (classes.join(cids, "cid", "left_semi").select(F.shiftright(at, 6).alias("w"), F.expr(
        f"shiftleft(1L, cast(pmod(xxhash64(rep), {BITMAP_BITS}) % 64 AS int))").alias("bit"))
        .groupBy("w").agg(F.bit_or("bit").alias("bits"))).toArrow()  # at most BITMAP_BITS / 64 rows
    bits = np.zeros(BITMAP_BITS // 64, np.uint64)
    bits[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bits


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose whole sets have a similarity of 0.8 or more (a written table)."""
    one, two = (classes.select(F.col("cid").alias(x), F.col("sig").alias(f"sig{x}"), F.col("n").alias(f"n{x}"),
                               F.col("parity").alias(f"p{x}")) for x in "ab")
    pairs = written(pairs.join(one, "a").join(two, "b").where(_may_link("pa", "pb", F.col("na") + F.col("nb")))
                    .select("a", "b", "siga", "sigb"), "pairs")
    cids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(classes, cids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches):
            at = np.array(cols["at"], np.int64)
            admitted = np.flatnonzero(bits.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            sets = {digest(s): s for s in shingle_sets([cols["text"][i] for i in admitted])}
            yield pa.RecordBatch.from_pydict({"sig": pa.array(list(sets), pa.binary()), "s": pa.array(
                [s.view(np.int64) for s in sets.values()], pa.list_(pa.int64()))})

    # one exchange of the sets, by digest, serves both sides of the pairs
    sets = (docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS)).alias("at"), "text")
            .mapInArrow(run, "sig binary, s array<long>").dropDuplicates(["sig"]))
    left, right = (sets.select(F.col("sig").alias(f"sig{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    overlap = F.size(F.array_intersect("sa", "sb"))
    links = (pairs.join(left, "siga").join(right, "sigb")
             .where(overlap * 9 >= _needed(F.size("sa"), F.size("sb"))))
    return written(links.select("a", "b"), "links")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, sig, rep, root`` of every row of ``docs``.

    ``sig`` is the digest of the row's set, ``rep`` the least ``doc_id`` with that set and
    ``root`` the component, also where no row of it has a ``doc_id``.
    """
    docs = docs.select("doc_id", "text")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs))
    rows = written(described(docs, frequent), "shingle-rows")
    classes = classes_of(rows)
    near = verified(docs, classes, star_pairs(classes))
    roots = written(connected_components(near), "roots")
    rest = verified(docs, classes, candidate_pairs(docs, frequent, classes, roots))
    frequent.unpersist()  # the rows read from here on are written
    # links of the join connect what the stars have connected
    final = connected_components(near.unionByName(rest))
    named = (classes.select("cid", "sig", "rep").join(final.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_sig = named.join(least, "root").select("sig", "rep", "component_id", "root")
    alone = F.when(F.col("sig").isNull(), F.col("doc_id"))
    return rows.select("doc_id", "sig", "n").join(by_sig, "sig", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", alone).alias("component_id"), "sig", "rep", "root")


def one_of_each(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, one row of each component (the least ``doc_id``, of its sets the
    one of least digest) and every row without words."""
    found = jaccard_components(docs).where(F.col("sig").isNotNull())
    kept = (found.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "sig")).alias("least"))
            .select("least.sig", "least.rep"))

    columns = [F.col(f"`{c}`") for c in docs.columns]
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sigs = [digest(s) for s in shingle_sets(part.column(0).flatten()[place].to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sigs, pa.binary())], names=["doc", "sig"])

    given = docs.select(F.struct(*columns).alias("doc"))
    tagged = given.mapInArrow(run, f"doc {given.schema['doc'].dataType.simpleString()}, sig binary")
    # one key of join and window, so that whole texts are exchanged once, and copies of a set are spread
    tagged = tagged.withColumn("id", F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("-")))
    kept = kept.select("sig", F.coalesce(F.col("rep").cast("string"), F.lit("-")).alias("id"))
    order = Window.partitionBy("sig", "id").orderBy(*[F.col(f"doc.`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    chosen = (tagged.where("sig IS NOT NULL").join(kept.hint("merge"), ["sig", "id"])
              .withColumn("rn", F.row_number().over(order)).where("rn = 1"))
    return chosen.select("doc.*").unionByName(tagged.where("sig IS NULL").select("doc.*"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
