"""Operator 8: personal data, with information-theoretic sanitisation of revealing terms.

Base spans (emails, IP addresses, card and phone numbers) come from patterns with checks.
The corpus then tells which ordinary words give a found entity away. With N documents,
df(e) documents that hold entity e, df(t) that hold term t and df(t, e) that hold both,
anywhere in them:

    IC(e) = log2(N / df(e))            what naming e tells
    PMI(t, e) = log2(N df(t, e) / (df(t) df(e)))   what t tells about e
    disclosure(t, e) = PMI(t, e) / IC(e)           1: whoever reads t knows e

Documents that hold e in one passage (equal ``WINDOW`` terms on both sides; of a document's
passages of e the one of least hash stands for it) are copies and count once in all four
numbers of a pair, however often a document repeats e or t.

As disclosure(t, e) = 1 + log2(P(e | t)) / IC(e), what decides is P(e | t) = df(t, e) / df(t),
and that is an estimate. A term is sanitised where

* the disclosure by the lower confidence bound of P(e | t) (Wilson's, ``Z``) is at least
  ``DISCLOSURE``,
* meeting in so many documents is no chance: the Chernoff bound of the hypergeometric tail, times
  the number of terms that e is met with (Bonferroni), is at most ``CHANCE``, and
* t and e meet in at least ``LEAST`` documents that are no copies. Every word of one document
  alone meets whatever else that document holds, so one meeting is no evidence, in however
  large a corpus.

A term goes at each of its places in each document that holds e. From a disclosure (the
estimate) of ``REMOVE`` on it is removed, below that generalised to a class mark.

All counts cover all documents: words are counted in each task's table before they are
shuffled. Entities and terms that too few documents hold, and terms too frequent for the threshold
whatever they are met with, are left out before terms meet entities, so a list of addresses
that no other document holds makes no pairs. Keys that many rows share are joined by broadcast.

Defined results: NULL and empty texts have no spans; offsets are code points of the whole
text, end exclusive; repeated rows (also with equal or NULL ``doc_id``) are separate
documents; an empty table gives no rows; all columns of the input may have any names.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from candlegap.llm.common import read_table, sliced, written

#: Kinds in the order that breaks ties of the start.
KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 6
CHANCE = 0.05
DISCLOSURE = 0.8
#: Quantile of the one-sided confidence bound (95 %), and documents in which a pair must meet.
Z = 1.645
LEAST = 2
REMOVE = 0.95
#: Distinct terms that a task counts before it hands them on.
TABLE_TERMS = 300_000
#: A key that more than one row in so many has is joined by broadcast.
COMMON = 100

# A run that fails once fails from each later position in it, so a match may begin only where
# a run begins or where the match before it ended: linear time on very long runs.
_EMAIL_HERE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL_HERE.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(d)] for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        m = (_EMAIL_HERE.match(text, at) if at else None) or _EMAIL.search(text, at)
        if m is None:
            return
        yield m.span()
        at = m.end()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base span, in order."""
    if not text:
        return []
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value.encode("utf-8")) - (1 << 63)


def contexts(text: str, spans: list[tuple[int, int, int]], window: int) -> tuple[list[dict], list[dict]]:
    """The entities of a text, each with the hash of the passage that stands for it, and
    the terms outside the spans, each with its places."""
    if not spans:
        return [], []
    ends = [e for _, _, e in spans]
    terms, places = [], {}
    for m in _TERM.finditer(text):
        k = bisect.bisect_right(ends, m.start())
        if all(s >= m.end() or e <= m.start() for s, _, e in spans[max(0, k - 2):k + 3]):
            term = m[0].lower()
            terms.append((m.start(), term))
            places.setdefault(term, []).append({"start": m.start(), "end": m.end()})
    starts, least = [t[0] for t in terms], {}
    for s, kind, e in spans:
        entity = _hash(f"{kind}:{text[s:e].lower()}")
        at = bisect.bisect_left(starts, s)
        ctx = _hash(" ".join(t for _, t in terms[max(0, at - window):at + window]))
        least[entity] = min(ctx, least.get(entity, ctx))
    return ([{"entity": e, "ctx": c} for e, c in least.items()],
            [{"term": t, "places": p} for t, p in places.items()])


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "base array<struct<start:int,kind:int,end:int>>, entities array<struct<entity:long,ctx:long>>, "
         "words array<struct<term:string,places:array<struct<start:int,end:int>>>>")


def detect(docs: DataFrame, kept: list[str], text: str = "text", window: int = WINDOW) -> DataFrame:
    """Base spans, entities and the terms of their documents, a written table: columns ``doc`` (a struct of the
    input's ``kept`` columns), those of FOUND, and ``row``, a number for the row."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([given.schema["doc"], *T.StructType.fromDDL(FOUND).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = {name: [] for name in arrow.names[1:]}
                for value in part.column(1).to_pylist():
                    spans = base_spans(value)
                    counts = Counter(kind for _, kind, _ in spans)
                    for kind, name in enumerate(("n_email", "n_ip", "n_card", "n_phone")):
                        rows[name].append(counts[kind])
                    joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                    rows["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                    rows["base"].append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                    entities, words = contexts(value, spans, window)
                    rows["entities"].append(entities)
                    rows["words"].append(words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(arrow.field(0).type), *(pa.array(rows[f.name], f.type) for f in list(arrow)[1:])],
                    schema=arrow)

    return written(given.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "pii-found")


def term_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``term, n``: the number of documents that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"term": pa.array(list(table), pa.string()),
                                               "n": pa.array(list(table.values()), pa.int64())})

        for cols in sliced(batches):
            for value in cols["text"]:
                if value:
                    table.update({t.lower() for t in set(_TERM.findall(value))})
            if len(table) >= TABLE_TERMS:
                yield out()
                table.clear()
        if table:
            yield out()

    return (docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def _joined(left: DataFrame, right: DataFrame, key: list[str], count: str, rows: float) -> DataFrame:
    """``left`` joined with ``right``, of whose ``key`` ``count`` tells about how many rows of
    ``left`` have it: keys with more than a ``COMMON``-th of ``rows`` go by broadcast."""
    common = F.broadcast(right.where(F.col(count) > max(rows / COMMON, COMMON)))
    rest = right.where(F.col(count) <= max(rows / COMMON, COMMON))
    return (left.join(common, key)
            .unionByName(left.join(common.select(key), key, "left_anti").join(rest, key)))


def _exponent(n: Column, k: Column, p: Column) -> Column:
    """-ln of the Chernoff bound that at least ``k`` of ``n`` draws hit, each with chance ``p``."""
    a = k / n
    rest = F.when(a < 1, (1 - a) * F.log((1 - a) / (1 - p))).otherwise(0.0)
    return F.when(a > p, n * (a * F.log(a / p) + rest)).otherwise(0.0)


def candidates(found: DataFrame, docs: DataFrame, n: int, text: str = "text",
               disclosure: float = DISCLOSURE, least: int = LEAST) -> DataFrame:
    """``row, ctx, term, df_term, e`` for each entity (the struct ``e``: entity, its documents,
    passages, and terms tested) and each term of its document that ``least`` documents hold and
    that is rare enough to reveal it."""
    private = found.where(F.size("entities") > 0)
    held = private.select("row", F.size("words").alias("m"), F.explode("entities").alias("x")).select("row", "m", "x.*")
    entities = (held.groupBy("entity", "ctx").agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("m"))
                .groupBy("entity").agg(F.sum("n").alias("df"), F.count(F.lit(1)).alias("passages"), F.sum("m").alias("m")))
    entities = written(entities.where(F.col("passages") >= least), "pii-entities")
    total = F.col("n_docs") - F.col("df") + F.col("passages")
    # at most df - passages of a term's documents are copies, and the others must be few
    most = F.col("df") - F.col("passages") + total * F.pow(F.col("passages") / total, F.lit(disclosure))
    entities = (entities.withColumn("n_docs", F.lit(float(n))).withColumn("most", most * (1 + 1e-9))
                .select("entity", "df", F.struct("entity", "df", "passages", "m").alias("e"), "most"))
    n_held = entities.agg(F.sum("df")).first()[0] or 0
    held = _joined(held.select("row", "entity", "ctx"), entities, ["entity"], "df", n_held).select("row", "ctx", "e", "most")
    held = written(held, "pii-held")
    terms = written(term_documents(docs, text).withColumnRenamed("n", "df_term"), "pii-terms")
    words = private.select("row", F.explode("words.term").alias("term"))
    words = words.join(held.groupBy("row").agg(F.max("most").alias("row_most")), "row")
    words = _joined(words, terms.where(F.col("df_term") >= least), ["term"], "df_term", n).where("df_term <= row_most").select("row", "term", "df_term")
    near = held.join(words, "row").where("df_term <= most").select("row", "ctx", "term", "df_term", "e")
    return written(near, "pii-candidates")


def _lower(k: Column, n: Column) -> Column:
    """Wilson's lower confidence bound of a share of which ``k`` of ``n`` were seen."""
    p, z2 = k / n, Z * Z
    return (p + z2 / (2 * n) - Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def revealing_terms(near: DataFrame, n: int, chance: float = CHANCE, disclosure: float = DISCLOSURE,
                    least: int = LEAST) -> DataFrame:
    """``entity, term, both, disclosure`` of the terms that give an entity away, from ``candidates``."""
    pairs = (near.groupBy("e", "term", "df_term", "ctx").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("e", "term", "df_term").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("k")))
    # every number without the copies
    total = F.lit(float(n)) - F.col("e.df") + F.col("e.passages")
    of_e, of_t, k = F.col("e.passages"), F.col("df_term") - F.col("both") + F.col("k"), F.col("k")
    ic = F.log2(total / of_e)
    pmi = F.log2(k * total / (of_t * of_e))
    sure = 1 + F.log2(_lower(k, of_t)) / ic
    exponent = F.greatest(_exponent(of_e, k, of_t / total), _exponent(of_t, k, of_e / total))
    return (pairs.withColumn("disclosure", F.when(ic > 0, pmi / ic))
            .where((ic > 0) & (k >= least) & (sure >= disclosure) & (exponent >= F.log(F.col("e.m") / F.lit(chance))))
            .select("e.entity", "term", "both", "disclosure"))


def term_spans(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``row, terms``: the spans of revealing terms of each row that has some."""
    n = found.count()
    near = candidates(found, docs, n, text)
    revealing = written(revealing_terms(near, n), "pii-revealing")
    n_near = near.count()
    rows = (_joined(near.select("row", "e.entity", "term"), revealing, ["entity", "term"], "both", n_near)
            .groupBy("row", "term").agg(F.max("disclosure").alias("disclosure")))
    words = (found.where(F.size("entities") > 0).select("row", F.explode("words").alias("w"))
             .select("row", "w.term", "w.places"))
    return (words.join(rows, ["row", "term"]).select("row", "disclosure", F.explode("places").alias("p"))
            .groupBy("row").agg(F.collect_list(F.struct("p.start", F.lit(4).alias("kind"), "p.end", "disclosure")).alias("terms")))


def all_spans() -> Column:
    """Base and term spans of a row in order, from the columns ``base`` and ``terms``."""
    kind = "array<struct<start:int,kind:int,end:int,disclosure:double>>"
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                  s["end"].alias("end"), F.lit(None).cast("double").alias("disclosure")))
    return F.array_sort(F.concat(base.cast(kind), F.coalesce(F.col("terms").cast(kind), F.array().cast(kind))))


def spans_string(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and spans of personal data and revealing terms, one row per document."""
    found = detect(docs, ["doc_id"], text)
    spans = term_spans(found, docs, text)
    return found.join(spans, "row", "left").select(
        "doc.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans_string(all_spans()).alias("spans"))


def cleaned(text: str | None, spans: list[dict]) -> str | None:
    """The text with its spans generalised to class marks, or removed."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out.append(text[at:s["start"]])
            if s["kind"] < 4:
                out.append(f"[{KINDS[s['kind']].upper()}]")
            elif s["disclosure"] < REMOVE:
                out.append("[TERM]")
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the text sanitised."""
    found = detect(docs, docs.columns, text)
    spans = term_spans(found, docs, text)
    schema, place = docs.schema, docs.columns.index(text)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = part.column(0).flatten()
                texts = [cleaned(t, s) for t, s in
                         zip(columns[place].to_pylist(), part.column(1).to_pylist(), strict=True)]
                columns[place] = pa.array(texts, arrow.field(place).type)
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return found.join(spans, "row", "left").select("doc", all_spans().alias("spans")).mapInArrow(run, schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents", "doc_id", "text"))
