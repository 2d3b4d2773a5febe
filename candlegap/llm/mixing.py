"""Operator 7: mixing sources to target weights by Pfair scheduling, with DataFrame and SQL
functions only.

Each source's documents are cut into blocks of ``block_docs``. Weights are integers W, a
source's share is exactly w = W / Q with Q their sum. Block i (from 0) is released at slot
floor(i / w) and due at slot ceil((i + 1) / w); each slot goes to the released block with the
earliest deadline (ties: the source first by name). At every slot t each source has then had
its w t blocks to within less than one block, w being the target itself: all arithmetic is in
integers and nothing is rounded, however many slots or sources there are.

Unless ``weights`` are given, W is 1,000 times the square root of a source's size, to the nearest
integer. Given weights are taken as the decimal fractions they print as, and brought to one denominator.

**In parallel.** The slots are cut into ranges, each scheduled by a row of its own. A range that
begins at slot B must know which blocks earlier slots have served. Blocks due by B are served,
blocks released from B on are not; of each source at most one block spans B, and so many of
them are served as slots are left over. Which ones does not need the whole past: earliest
deadline first, run from a slot that all of them are released after and without what was
released before it, serves the blocks due by B and a largest set of the spanning ones in order
of deadline; the first of these are the ones served. So a range is computed from the range
before it alone, and the schedule is the one that a single run over all slots would give
(tested). Ranges are long enough to hold a whole window of the least weight.

A document's rank in its source follows md5 of its id. Ranks are counted within 4,096 hash
buckets per source and shifted by the buckets before, so a source with a third of all rows
is 4,096 small windows and not one. Each bucket's row carries the slots of its own blocks.
No row is dropped or repeated. ``in_target`` marks the slots before the first one that a source can no longer
fill (the horizon), up to which the weights hold. The blocks left follow in order of deadline
and source: their slot is the horizon + (deadline - 1 - horizon) * sources + the source's
place by name, so ``slot, within`` is one order of all rows; numbers between are unused.

A range's row holds all sources and its slots, and its work is their product: the number of
sources is that of data sets or crawls, not of pages.

Defined results: a NULL source is a source of its own, by name the first; a source without
a positive weight in ``weights`` gets the smallest given one; weights that need integers above
2^31, that are negative or not finite are a ValueError; rows that repeat a ``doc_id`` are
placed one after another; a NULL ``doc_id`` hashes as the empty string; an empty table gives
no rows.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd, isfinite, lcm

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlegap.llm.common import read_table, spread, written

BLOCK_DOCS = 16
#: Least number of slots in a range, and slots whose picks are gathered at once within it.
RANGE_SLOTS, GATHERED = 1024, 256
#: Integer weights are the square roots of the sizes times this.
WEIGHT_SCALE = 1000
BUCKET_DIGITS = 3
PLACED = ["block", "within", "release", "deadline", "slot", "in_target"]

_DEADLINE = "((({v}) + 1) * q + ws[i] - 1) div ws[i]"
_PICK = f"""
array_min(transform(a.c, (v, i) ->
  if(v * q div ws[i] <= t, {_DEADLINE.format(v='v')} * size(ws) + i, null))) % size(ws)
"""
#: One slot: the picked source's count rises; without a released block the slot stays idle.
_SLOT = f"""
element_at(transform(array(cast({_PICK} AS int)), p -> named_struct(
  'c', transform(a.c, (v, i) -> if(i <=> p, v + 1, v)),
  'o', {{picks}})), 1)
"""


def _edf(counts: str, first: str, last: str, gather: bool) -> str:
    """SQL: earliest deadline first over the slots ``first`` to ``last``, from ``counts`` blocks
    served of each source: a struct of the counts ``c`` and, gathered, the picks ``o``."""
    kept = "array<struct<s:int,j:bigint>>"
    picks = "if(p IS NULL, a.o, concat(a.o, array(named_struct('s', p, 'j', a.c[p]))))" if gather else "a.o"
    inner = f"""aggregate(sequence(u, least(u + {GATHERED - 1}, {last})),
      named_struct('c', g.c, 'o', cast(array() AS {kept})), (a, t) -> {_SLOT.format(picks=picks)})"""
    return f"""aggregate(sequence({first}, {last}, {GATHERED}L),
      named_struct('c', {counts}, 'o', cast(array() AS array<{kept}>)),
      (g, u) -> element_at(transform(array({inner}), x -> named_struct(
        'c', x.c, 'o', {'concat(g.o, array(x.o))' if gather else 'g.o'})), 1))"""


#: Counts at the begin ``b`` of a range: those of the blocks due by then, and the first spanning
#: blocks by deadline of those that the range before serves.
_WARM = _edf("transform(ws, w -> ((b - l) * w + q - 1) div q)", "b - l", "b - 1", gather=False) + ".c"
_SPANNING = f"if(v > b * ws[i] div q, {_DEADLINE.format(v='v - 1')} * size(ws) + i, null)"
_START = f"""
if(b = 0, transform(ws, w -> 0L), element_at(transform(array({_WARM}), c -> element_at(transform(array(coalesce(
  get(array_sort(filter(transform(c, (v, i) -> {_SPANNING}), k -> k IS NOT NULL)),
      cast(b - aggregate(ws, 0L, (n, w) -> n + b * w div q) - 1 AS int)), -1L)),
  most -> transform(c, (v, i) -> b * ws[i] div q + if({_SPANNING} <= most, 1L, 0L))), 1)), 1))
"""


def integer_weights(weights: dict[str, float]) -> dict[str, int]:
    """The weights as integers in the same proportions."""
    if not all(isfinite(w) and w >= 0 for w in weights.values()):
        raise ValueError("weights must be finite and not negative")
    exact = {s: Fraction(str(w)) for s, w in weights.items() if w > 0}
    if not exact:
        raise ValueError("no positive weight")
    scale = lcm(*(f.denominator for f in exact.values()))
    whole = {s: int(f * scale) for s, f in exact.items()}
    common = gcd(*whole.values())
    whole = {s: w // common for s, w in whole.items()}
    if max(whole.values()) > 1 << 31:
        raise ValueError("weights of so many digits have no common denominator of fitting size")
    return whole


def _weighted(sizes: DataFrame, weights: dict[str, float] | None, block_docs: int) -> DataFrame:
    """One row: ``sources`` (src, w, blocks) by name, ``q``, slots ``h`` that hold the first block
    that a source lacks, and the length ``l`` of a range."""
    if weights:
        whole = integer_weights(weights)
        given = F.create_map(*[F.lit(x) for s, w in whole.items() for x in (f"s:{s}", w)])
        weight = F.coalesce(F.try_element_at(given, F.col("src")), F.lit(min(whole.values()))).cast("long")
    else:
        weight = F.floor(F.sqrt(F.col("n").cast("double")) * WEIGHT_SCALE + 0.5).cast("long")
    blocks = F.ceil(F.col("n") / F.lit(block_docs)).cast("long")
    one = sizes.agg(F.array_sort(F.collect_list(F.struct("src", weight.alias("w"), blocks.alias("blocks")))).alias("sources"),
                    F.sum(weight).alias("q"), F.min(weight).alias("least")).where("q IS NOT NULL")
    return one.select("sources", "q",
                      F.expr("array_min(transform(sources, s -> ((s.blocks + 1) * q + s.w - 1) div s.w))").alias("h"),
                      F.expr(f"greatest({RANGE_SLOTS}L, q div least + 2)").alias("l"))


def schedule(weighted: DataFrame) -> DataFrame:
    """``src, block, slot, missing`` of the slots before ``h``; a source has no such block where
    ``missing``."""
    ranges = spread(weighted.select("sources", F.expr("sources.w").alias("ws"), "q", "h", "l", F.explode(
        F.expr("sequence(0L, (h - 1) div l)")).alias("range")), "range").withColumn("b", F.col("range") * F.col("l"))
    started = ranges.withColumn("start", F.expr(_START))
    run = _edf("start", "b", "least(b + l, h) - 1", gather=True)
    # outer: the inner form would compute its array once more to see that it is not empty
    picks = started.select("sources", "b", F.posexplode_outer(F.expr(f"flatten({run}.o)")).alias("at", "x"))
    source = F.get("sources", F.col("x.s"))
    return picks.select(source["src"].alias("src"), F.col("x.j").alias("block"), (F.col("b") + F.col("at")).alias("slot"),
                        (F.col("x.j") >= source["blocks"]).alias("missing"))


def place(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Every row of ``docs`` with its place in the mix, in the struct column ``mix``."""
    src = F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("null"))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(F.struct("*").alias("doc"), src.alias("src"), key.alias("key"),
                        F.substring(key, 1, BUCKET_DIGITS).alias("bucket"))
    buckets = keyed.groupBy("src", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = F.expr(f"offset div {block_docs}")
    offsets = (buckets.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .withColumn("first", first).withColumn("last", F.expr(f"(offset + n - 1) div {block_docs}")))
    weighted = _weighted(buckets.groupBy("src").agg(F.sum("n").alias("n")), weights, block_docs)
    slots = written(schedule(weighted), "mix-schedule")
    horizon = slots.where("missing").agg(F.min("slot").alias("horizon"))
    sources = weighted.select("q", F.size("sources").alias("of"), F.posexplode("sources").alias("turn", "s")).select(
        "q", "of", "turn", "s.src", "s.w")

    # the slots of a bucket's blocks, from its first block on
    spans = offsets.select("src", "bucket", F.explode(F.sequence("first", "last")).alias("block"))
    own = (spans.join(slots.where("NOT missing").select("src", "block", "slot"), ["src", "block"])
           .groupBy("src", "bucket").agg(F.array_sort(F.collect_list(F.struct("block", "slot"))).alias("own")))
    known = (offsets.join(own, ["src", "bucket"], "left").join(sources, "src")
             .select("src", "bucket", "offset", "first", F.col("own.slot").alias("own"), "q", "w", "of", "turn")
             .join(F.broadcast(horizon)))  # one row

    in_bucket = Window.partitionBy("src", "bucket").orderBy("key", "doc.doc_id")
    placed = (keyed.withColumn("rn", F.row_number().over(in_bucket)).join(known, ["src", "bucket"])
              .withColumn("rank", F.col("offset") + F.col("rn") - 1)
              .withColumn("block", F.expr(f"rank div {block_docs}"))
              .withColumn("deadline", F.expr("((block + 1) * q + w - 1) div w"))
              .withColumn("at", F.get("own", (F.col("block") - F.col("first")).cast("int"))))
    inside = F.coalesce(F.col("at") < F.col("horizon"), F.lit(False))
    return placed.select("doc", F.struct(
        "block", (F.col("rank") % block_docs).cast("int").alias("within"), F.expr("block * q div w").alias("release"), "deadline",
        F.when(inside, F.col("at")).otherwise(F.expr("horizon + (deadline - 1 - horizon) * of + turn")).alias("slot"),
        inside.alias("in_target")).alias("mix"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """All rows and columns of ``docs``, in the order of the mix."""
    return place(docs, weights, block_docs).orderBy("mix.slot", "mix.within").select("doc.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source")
    return place(docs).select("doc.doc_id", "doc.source", *[f"mix.{c}" for c in PLACED])


#: One run over all slots, where the query runs the ranges apart.
ORACLE_OP7 = f"""
WITH RECURSIVE keyed AS (
  SELECT doc_id, source, coalesce('s:' || source, 'null') AS src,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
sources AS (SELECT src, (n + {BLOCK_DOCS - 1}) // {BLOCK_DOCS} AS blocks, row_number() OVER (ORDER BY src) - 1 AS turn,
                   CAST(floor(sqrt(CAST(n AS DOUBLE)) * {WEIGHT_SCALE} + 0.5) AS BIGINT) AS w
            FROM (SELECT src, count(*) AS n FROM keyed GROUP BY src)),
cfg AS (SELECT list(src ORDER BY src) AS names, list(w ORDER BY src) AS ws, list(blocks ORDER BY src) AS bs,
               CAST(sum(w) AS BIGINT) AS q, count(*) AS s FROM sources),
ends AS (SELECT min(((blocks + 1) * q + w - 1) // w) AS h FROM sources, cfg),
runs(t, c, p, j) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM cfg WHERE s > 0
  UNION ALL
  SELECT t + 1, list_transform(c, lambda v, i: CASE WHEN i = pick THEN v + 1 ELSE v END), pick, c[pick]
  FROM (SELECT t, c, 1 + list_min(list_transform(range(1, s + 1), lambda i:
          CASE WHEN c[i] * q // ws[i] <= t + 1
               THEN ((c[i] + 1) * q + ws[i] - 1) // ws[i] * s + (i - 1) END)) % s AS pick
        FROM runs, cfg, ends WHERE t + 1 < h)),
slots AS (SELECT names[p] AS src, j AS block, t AS pos, j >= bs[p] AS missing FROM runs, cfg WHERE t >= 0),
horizon AS (SELECT min(pos) AS h FROM slots WHERE missing),
ranked AS (SELECT *, rank // {BLOCK_DOCS} AS block FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY key, doc_id) - 1 AS rank FROM keyed)),
dated AS (SELECT ranked.*, turn, block * q // w AS release, ((block + 1) * q + w - 1) // w AS deadline
          FROM ranked JOIN sources USING (src), cfg)
SELECT doc_id, source, dated.block, CAST(rank % {BLOCK_DOCS} AS INTEGER) AS within, release, deadline,
       CASE WHEN coalesce(pos < h, false) THEN pos ELSE h + (deadline - 1 - h) * s + turn END AS slot,
       coalesce(pos < h, false) AS in_target
FROM dated CROSS JOIN horizon CROSS JOIN cfg LEFT JOIN slots ON slots.src = dated.src AND slots.block = dated.block
"""
