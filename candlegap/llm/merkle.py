"""Operator 11: Merkle manifest of a dataset, by lag and lead windows.

H is the lower-case hex sha256 of its inputs in order, digests as hex text. A row's leaf is H of
its fields, each ``-`` if NULL, else its UTF-8 byte count, ``:`` and its value. Within a group
(the language) leaves ascend by ``doc_id``; while more than one node remains, every
``FANOUT`` consecutive ones (the last run may be shorter, even one) become their H. What
remains is the group's subroot; the subroots, ordered by group, give the root likewise.

Each level is one window over leaf rows in order. A node of level l lives on the row of its first
leaf; its siblings stand at fixed offsets of k * FANOUT**l rows, so ``lag`` and ``lead`` columns,
masked by the node's slot and its run's length, supply them, and the row of a run's first child
hashes the parent. ``LEVELS`` such windows share one exchange and one sort: they are
partitioned by chunks of FANOUT**LEVELS leaves, which hold whole runs only, so a group of any
size is many equal windows. What a chunk comes to is a leaf of the next climb. A document's path
is its siblings level by level, its chunk's path appended by a join on the chunk.

Places are given by a range exchange on (group, doc_id, leaf): the order is in the written
table, per-partition counts shift it to places in the group. Texts are read and hashed once.

Defined results: a NULL language is a group of its own, the first; NULL ``doc_id`` come first
in their group, and their text is not tampered with; rows that repeat a ``doc_id`` follow one
another by leaf; equal rows take consecutive places and are separate leaves; a lone leaf is
its own subroot, and where there is one group its subroot is the root; without siblings the proof
is H of nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlegap.llm.common import read_table, written

FANOUT = 8
#: Levels climbed within one exchange, over chunks of FANOUT ** LEVELS rows.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A document is tampered with where this divides the crc32 of its id.
TAMPERED = 3
_CHUNK = FANOUT ** LEVELS
_SIDES = "struct<l:string,r:string>"


def digest(*inputs: Column) -> Column:
    """H of text inputs; NULL ones are left out."""
    return F.sha2(F.concat_ws("", *inputs), 256)


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """A row's leaf, with another text if one is given."""
    return digest(*[_field(text if c == "text" and text is not None else F.col(c)) for c in FIELDS])


def leaves(docs: DataFrame) -> DataFrame:
    """``grp, doc_id, leaf, changed``: ``changed`` is the leaf of the row as it is found later,
    which a tampered text alters. ``grp`` sorts as the language does, NULL first."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    grp = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    leaf = leaf_digest()
    return docs.select(grp.alias("grp"), "doc_id", leaf.alias("leaf"),
                       F.when(hit & (lowered != F.col("text")), leaf_digest(lowered)).otherwise(leaf).alias("changed"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the place in the group by ``order`` (from 0), and ``n``, the group's size.

    Equal rows are told apart by where they were read, so any number of them is spread over
    range partitions. The order is written once; places are counted from the written table."""
    held = rows.columns
    ranged = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = (ranged.repartitionByRange("grp", *order, "tie").sortWithinPartitions("grp", *order, "tie")
              .select(*held, F.monotonically_increasing_id().alias("at")))
    ranged = written(ranged, "merkle-order").withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("grp", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                          F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    return (ranged.join(shifts, ["grp", "part"])
            .select(*held, (F.col("at") + F.col("shift")).alias("i"), "n"))


def _climb(nodes: DataFrame, paths: bool) -> DataFrame:
    """``nodes`` (grp, i, n, h, ...) with ``chunk`` and ``top``, on a chunk's first row what the
    chunk comes to. With ``paths``, ``path``: a (left, right) pair of sibling digests for each level
    that the group has within the chunk."""
    order = Window.partitionBy("grp", "chunk").orderBy("i")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = nodes.withColumn("chunk", F.expr(f"i div {_CHUNK}")).withColumn("h0", F.col("h"))
    for level in range(LEVELS):
        unit = FANOUT ** level
        first = F.col("i") % unit == 0
        slot = F.expr(f"i div {unit}") % FANOUT
        alive = F.expr(f"(n + {unit - 1}) div {unit}")  # the group's nodes at this level
        length = F.least(F.lit(FANOUT), alive - (F.expr(f"i div {unit}") - slot))
        h = F.col(f"h{level}")
        later = [F.when(slot + k < length, F.lead(h, k * unit).over(order)) for k in range(1, FANOUT)]
        parent = F.when(alive > 1, digest(h, *later)).otherwise(h)
        columns = {f"h{level + 1}": F.when(F.col("i") % (unit * FANOUT) == 0, parent)}
        if paths:
            earlier = [F.when(slot >= k, F.lag(h, k * unit).over(order)) for k in range(FANOUT - 1, 0, -1)]
            columns[f"s{level}"] = F.when(first & (alive > 1), F.struct(
                F.concat_ws("", *earlier).alias("l"), F.concat_ws("", *later).alias("r")))
        out = out.withColumns(columns)
    out = out.withColumn("top", F.col(f"h{LEVELS}"))
    if paths:
        # a node's row is its first leaf's: the last one at or before each row
        sides = [F.last(f"s{level}", ignorenulls=True).over(so_far) for level in range(LEVELS)]
        out = out.withColumn("path", F.filter(F.array(*sides), lambda s: s.isNotNull()))
    return out


def _chunks(nodes: DataFrame) -> DataFrame:
    """The nodes of the next climb: one row for each chunk."""
    return (_climb(nodes, paths=False).where(F.col("top").isNotNull() & (F.col("i") % _CHUNK == 0))
            .select("grp", F.col("chunk").alias("i"), F.expr(f"(n + {_CHUNK - 1}) div {_CHUNK}").alias("n"),
                    F.col("top").alias("h")))


def tree(nodes: DataFrame) -> list[DataFrame]:
    """The climbs from ``nodes`` (grp, i, n, h) up: the last has one row a group, its subroot."""
    climbs = [nodes]
    size = nodes.agg(F.max("n")).first()[0] or 1
    while size > 1:
        climbs.append(written(_chunks(climbs[-1].select("grp", "i", "n", "h")), "merkle-nodes"))
        size = -(-size // _CHUNK)
    return climbs


def paths(climbs: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first climb's rows with ``path`` up to the top of what ``above`` gives for each group
    (grp, path, and columns that every row of the group gets)."""
    given = [c for c in above.columns if c not in ("grp", "path")]
    known = above.withColumn("chunk", F.lit(0).cast("long"))
    for nodes in reversed(climbs[:-1]):
        upper = known.withColumnRenamed("path", "upper")
        joined = _climb(nodes, paths=True).join(upper, ["grp", "chunk"])
        known = joined.select(*nodes.columns, *given, F.concat("path", "upper").alias("path"))
        if nodes is not climbs[0]:
            known = known.select("grp", F.col("i").alias("chunk"), "path", *given)
    return known if len(climbs) > 1 else climbs[0].join(above, "grp")


def proof(path: str = "path") -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def folded(start: Column, path: str = "path") -> Column:
    """The root that ``start`` gives with the siblings of ``path``."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and whether the row as found later still folds
    to the root."""
    rows = written(leaves(docs.select(*FIELDS)), "merkle-leaves")
    climbs = tree(placed(rows, ["doc_id", "leaf"]).withColumnRenamed("leaf", "h"))
    subroots = climbs[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("h").alias("subroot"))
    upper = tree(placed(subroots, ["of"]).withColumnRenamed("subroot", "h"))
    roots = upper[-1].select("grp", F.col("h").alias("root"), F.array().cast(f"array<{_SIDES}>").alias("path"))
    above = paths(upper, roots).select(F.col("of").alias("grp"), "path", F.col("h").alias("subroot"), "root")
    found = paths(climbs, above)
    again = folded(F.col("changed"))
    return found.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", proof().alias("proof_sha256"),
                        again.alias("folded_root"), (again == F.col("root")).alias("verified"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents", *FIELDS))



def _sql_field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


#: crc32 of the decimal doc_id, bit by bit: each byte comes with the first of its eight bits.
_SQL_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                           lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))"""
_LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _sql_tree(name: str, leaf_rows: str) -> str:
    """All nodes of the trees over ``leaf_rows`` (g, i, n, h), and their runs."""
    return f"""{name}(lvl, g, i, n, h) AS (
  SELECT CAST(0 AS BIGINT), g, i, n, h FROM {leaf_rows}
  UNION ALL
  SELECT lvl + 1, g, i // {FANOUT}, (max(n) + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY lvl, g, i // {FANOUT}),
{name}_runs AS (SELECT lvl, g, i // {FANOUT} AS run, list(h ORDER BY i) AS hs FROM {name} GROUP BY ALL)"""


def _sql_walk(name: str, trees: str, start: str) -> str:
    """From ``start`` (id, g, i, n, siblings, h) to the tops, gathering siblings and folding."""
    left, right = f"array_to_string(hs[:i % {FANOUT}], '')", f"array_to_string(hs[i % {FANOUT} + 2:], '')"
    return f"""{name}(id, lvl, g, i, n, siblings, h) AS (
  SELECT id, CAST(0 AS BIGINT), g, i, n, siblings, h FROM {start}
  UNION ALL
  SELECT id, w.lvl + 1, w.g, i // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, siblings || {left} || {right},
         sha256({left} || h || {right})
  FROM {name} w JOIN {trees}_runs r ON w.lvl = r.lvl AND w.g = r.g AND w.i // {FANOUT} = r.run WHERE n > 1)"""


ORACLE_OP11 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_sql_leaf("text")} AS h,
         CASE WHEN {_SQL_CRC} % {TAMPERED} = 0 THEN {_sql_leaf(_LOWERED)} ELSE {_sql_leaf("text")} END AS changed
  FROM documents),
q AS (SELECT *, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, h) AS id, count(*) OVER (PARTITION BY g) AS n,
             row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves),
{_sql_tree("tree", "q")},
subroots AS (SELECT g AS lang, 0 AS g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n
             FROM tree WHERE n = 1),
{_sql_tree("upper", "subroots")},
starts AS (SELECT id, g, i, n, '' AS siblings, changed AS h FROM q),
{_sql_walk("walk", "tree", "starts")},
middle AS (SELECT w.id, s.g, s.i, s.n, w.siblings, w.h FROM walk w JOIN subroots s ON s.lang = w.g WHERE w.n = 1),
{_sql_walk("last", "upper", "middle")}
SELECT q.doc_id, q.h AS leaf, s.h AS subroot, u.h AS root, sha256(w.siblings) AS proof_sha256,
       w.h AS folded_root, w.h = u.h AS verified
FROM q JOIN last w ON w.id = q.id AND w.n = 1 JOIN subroots s ON s.lang = q.g, (SELECT h FROM upper WHERE n = 1) u
"""
