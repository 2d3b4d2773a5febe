"""Price documents as the data provider returns them: classify and flatten.

A document is one JSON object per instrument: a ``Meta Data`` map naming the
pair and a ``Time Series FX (Daily)`` map from date to the four prices, or an
``Error Message`` / ``Note`` instead of (or beside) the series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from candlegap.functions.columns import timestamp_literal

# Field names of the provider's daily FX document.
META_KEY = "Meta Data"
FROM_KEY = "2. From Symbol"
TO_KEY = "3. To Symbol"
SERIES_KEY = "Time Series FX (Daily)"
OPEN_KEY, HIGH_KEY, LOW_KEY, CLOSE_KEY = "1. open", "2. high", "3. low", "4. close"
ERROR_KEY = "Error Message"
NOTE_KEY = "Note"

DOCUMENT_SCHEMA = StructType([
    StructField(META_KEY, MapType(StringType(), StringType()), True),
    StructField(SERIES_KEY, MapType(StringType(), MapType(StringType(), StringType())), True),
    StructField(ERROR_KEY, StringType(), True),
    StructField(NOTE_KEY, StringType(), True),
])

ACCEPTED, WARNING, REJECTED = "accepted", "warning", "rejected"


def read_documents(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Documents with the fixed schema (one per line, or one per file with
    ``multi_line``); no schema inference over the maps."""
    return (spark.read.schema(DOCUMENT_SCHEMA)
            .option("multiLine", str(multi_line).lower()).json(path))


def _meta(key: str) -> Column:
    return F.col(f"`{META_KEY}`")[key]


def classify_documents(docs: DataFrame) -> DataFrame:
    """Tag each document: ``status`` accepted / warning / rejected, ``reason``.

    An error message rejects the document; a missing series or missing pair
    metadata rejects it; a note (rate-limit warning) keeps it but flags it.
    Adds ``from_symbol``, ``to_symbol`` (from the metadata) and ``n_days``
    (series length). One Project, no shuffle: documents are independent.
    """
    err, note, series = F.col(f"`{ERROR_KEY}`"), F.col(f"`{NOTE_KEY}`"), F.col(f"`{SERIES_KEY}`")
    meta = F.col(f"`{META_KEY}`")
    no_pair = meta.isNull() | _meta(FROM_KEY).isNull() | _meta(TO_KEY).isNull()
    status = (F.when(err.isNotNull(), F.lit(REJECTED))
              .when(series.isNull(), F.lit(REJECTED))
              .when(no_pair, F.lit(REJECTED))
              .when(note.isNotNull(), F.lit(WARNING))
              .otherwise(F.lit(ACCEPTED)))
    reason = (F.when(err.isNotNull(), F.concat(F.lit("error: "), err))
              .when(series.isNull(), F.lit("missing time series"))
              .when(no_pair, F.lit("missing pair metadata"))
              .when(note.isNotNull(), F.concat(F.lit("note: "), note)))
    return docs.withColumns({
        "from_symbol": _meta(FROM_KEY),
        "to_symbol": _meta(TO_KEY),
        "status": status,
        "reason": reason,
        # explicit: size(NULL) is -1 or NULL depending on the ANSI setting
        "n_days": F.when(series.isNull(), F.lit(0)).otherwise(F.size(series)),
    })


def flatten_documents(docs: DataFrame, *, ingest_ts: str, source: str) -> DataFrame:
    """Accepted and warned documents -> one bronze row per (pair, day).

    ``explode`` of the date map runs inside the scan's stage (a Generate
    node), in parallel over documents; the prices stay text for silver to
    parse. ``ingest_ts`` stamps the run, ``source`` names the provider.
    Output rows are sorted by date within each task.
    """
    kept = classify_documents(docs).filter(F.col("status") != REJECTED)
    rows = kept.select(
        "from_symbol", "to_symbol",
        F.explode(F.col(f"`{SERIES_KEY}`")).alias("date", "v"),
    )
    return rows.select(
        "date",
        F.col("v")[OPEN_KEY].alias("open"),
        F.col("v")[HIGH_KEY].alias("high"),
        F.col("v")[LOW_KEY].alias("low"),
        F.col("v")[CLOSE_KEY].alias("close"),
        "from_symbol", "to_symbol",
        timestamp_literal(ingest_ts).alias("_ingest_timestamp"),
        F.lit(source).alias("_source"),
    ).sortWithinPartitions("date")


def bronze_to_documents(bronze: DataFrame) -> DataFrame:
    """Bronze rows -> one document per pair (the provider's shape).

    Copies of a (pair, day) are first reduced to the latest one
    (``dedup_latest``: partial aggregation, map-side), so a document holds
    exactly one entry per day -- bounded by the pair's calendar, the
    provider's own unit of delivery -- and the date map has unique keys.
    Then groups by pair and builds the map with ``map_from_entries``. Used
    to build round-trip fixtures from the given tables.
    """
    from candlegap.operators.quality import dedup_latest

    bronze = dedup_latest(bronze)
    day = F.struct(
        F.col("date"),
        F.create_map(F.lit(OPEN_KEY), F.col("open"), F.lit(HIGH_KEY), F.col("high"),
                     F.lit(LOW_KEY), F.col("low"), F.lit(CLOSE_KEY), F.col("close")),
    )
    return bronze.groupBy("from_symbol", "to_symbol").agg(
        F.create_map(F.lit(FROM_KEY), F.col("from_symbol"),
                     F.lit(TO_KEY), F.col("to_symbol")).alias(META_KEY),
        F.map_from_entries(F.collect_list(day)).alias(SERIES_KEY),
    ).select(META_KEY, SERIES_KEY,
             F.lit(None).cast("string").alias(ERROR_KEY),
             F.lit(None).cast("string").alias(NOTE_KEY))
