"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the operator definitions, not from the Spark code. Where Spark
keeps decimals and DuckDB would divide in DOUBLE, the SQL works in scaled
integers and rounds half-up explicitly, step by step as Spark's decimal
types do (returns, rolling means, percentages, averages).
"""

from __future__ import annotations

import re

from candlegap.catalog import (
    NOTE_TEXT,
    ONE_PAIR,
    RUN_TS,
    RUN_TS_2,
    TOP,
    UPSERT_EXISTING_UNTIL,
    UPSERT_INCOMING_FROM,
    WHITELIST,
)
from candlegap.plans.reports import ORDERS

PAIR = "from_symbol, to_symbol"
W_PAIR = f"PARTITION BY {PAIR} ORDER BY date"
BRONZE_COLS = "date, open, high, low, close, from_symbol, to_symbol, _ingest_timestamp, _source"
SILVER_COLS = BRONZE_COLS + ", daily_range, daily_return"
GAP_COLS = ("date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low, fvg_size_pips, "
            "open, high, low, close")

EV_BARS = """ev_bars AS (
    SELECT CAST(ts AS DATE) AS bar_date, user_id,
           first(value ORDER BY ts, event_id) AS o,
           max(value) AS h,
           min(value) AS l,
           last(value ORDER BY ts, event_id) AS c,
           max(ts) AS stamp
    FROM events
    GROUP BY 1, 2)"""


def _txt(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(10,5)) AS VARCHAR)"


def bronze_cte(name: str, *, malformed=False, factor=None, shift_days=0, spread=False) -> str:
    o, h, l, c = (f"({x} * CAST({factor} AS DOUBLE))" if factor else x
                  for x in ("o", "h", "l", "c"))
    o, h, l, c = _txt(o), _txt(h), _txt(l), _txt(c)
    if malformed:
        k = "user_id % 7"
        o, h, l, c = (
            f"CASE WHEN {k} = 0 THEN 'bad' WHEN {k} = 4 THEN '-1' ELSE {o} END",
            f"CASE WHEN {k} = 2 THEN {l} ELSE {h} END",
            f"CASE WHEN {k} = 2 THEN {h} WHEN {k} = 3 THEN '0' ELSE {l} END",
            f"CASE WHEN {k} = 1 THEN NULL ELSE {c} END",
        )
    day = "bar_date + CAST(31 * (user_id % 6) AS INTEGER)" if spread else "bar_date"
    stamp = f"stamp + INTERVAL {shift_days} DAY" if shift_days else "stamp"
    return f"""{name} AS (
    SELECT CAST({day} AS VARCHAR) AS date,
           {o} AS open, {h} AS high, {l} AS low, {c} AS close,
           'U' || CAST(user_id AS VARCHAR) AS from_symbol,
           'USD' AS to_symbol,
           {stamp} AS _ingest_timestamp,
           'events' AS _source
    FROM ev_bars)"""


def typed_cte(name: str, src: str) -> str:
    return f"""{name} AS (
    SELECT TRY_CAST(date AS DATE) AS date,
           TRY_CAST(open AS DECIMAL(10,5)) AS open,
           TRY_CAST(high AS DECIMAL(10,5)) AS high,
           TRY_CAST(low AS DECIMAL(10,5)) AS low,
           TRY_CAST(close AS DECIMAL(10,5)) AS close,
           from_symbol, to_symbol, _ingest_timestamp, _source
    FROM {src})"""


GOOD = """date IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
      AND close IS NOT NULL AND high >= low AND open > 0 AND high > 0 AND low > 0 AND close > 0"""

REASON = """CASE WHEN date IS NULL THEN 'missing_date'
         WHEN open IS NULL THEN 'missing_open'
         WHEN high IS NULL THEN 'missing_high'
         WHEN low IS NULL THEN 'missing_low'
         WHEN close IS NULL THEN 'missing_close'
         WHEN high < low THEN 'high_below_low'
         WHEN open <= 0 THEN 'non_positive_open'
         WHEN high <= 0 THEN 'non_positive_high'
         WHEN low <= 0 THEN 'non_positive_low'
         WHEN close <= 0 THEN 'non_positive_close' END"""


def dedup_cte(name: str, src: str) -> str:
    return f"""{name} AS (
    SELECT {BRONZE_COLS} FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY date, from_symbol, to_symbol
            ORDER BY _ingest_timestamp DESC NULLS LAST, open DESC NULLS LAST,
                     high DESC NULLS LAST, low DESC NULLS LAST, close DESC NULLS LAST,
                     _source DESC NULLS LAST) AS rn
        FROM {src}) WHERE rn = 1)"""


def derive_cte(name: str, src: str) -> str:
    # return in units of 1e-5 percent = round_half_up(|c - p| * 1e7 / p), signed;
    # NULL beyond decimal(10,5)
    return f"""{name}_u AS (
    SELECT *, CAST(close * 100000 AS HUGEINT) AS cu,
           LAG(CAST(close * 100000 AS HUGEINT)) OVER ({W_PAIR}) AS pu
    FROM {src}),
{name} AS (
    SELECT {BRONZE_COLS},
           CAST(high - low AS DECIMAL(10,5)) AS daily_range,
           CAST(CASE WHEN ru < 10000000000 THEN sign(cu - pu) * ru END * 0.00001
                AS DECIMAL(10,5)) AS daily_return
    FROM (SELECT *, (abs(cu - pu) * 20000000 + pu) // (2 * pu) AS ru FROM {name}_u))"""


def silver_ctes(src: str, name: str = "silver") -> str:
    return ",\n".join([
        typed_cte(f"{name}_typed", src),
        f"{name}_clean AS (SELECT * FROM {name}_typed WHERE {GOOD})",
        dedup_cte(f"{name}_dedup", f"{name}_clean"),
        derive_cte(name, f"{name}_dedup"),
    ])


def gap_ctes(src: str = "silver", name: str = "gaps", levels: str = "ordered") -> str:
    bear_hi, bear_lo = ("prev_low", "next_high") if levels == "ordered" else ("next_high", "prev_low")
    return f"""{name}_nb AS (
    SELECT *, LAG(high) OVER ({W_PAIR}) AS prev_high, LAG(low) OVER ({W_PAIR}) AS prev_low,
           LEAD(high) OVER ({W_PAIR}) AS next_high, LEAD(low) OVER ({W_PAIR}) AS next_low
    FROM {src}),
{name}_lv AS (
    SELECT *,
           CASE WHEN prev_high < next_low THEN 'bullish'
                WHEN prev_low > next_high THEN 'bearish' END AS fvg_type,
           CASE WHEN prev_high < next_low THEN next_low
                WHEN prev_low > next_high THEN {bear_hi} END AS fvg_high,
           CASE WHEN prev_high < next_low THEN prev_high
                WHEN prev_low > next_high THEN {bear_lo} END AS fvg_low
    FROM {name}_nb),
{name} AS (
    SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low,
           CAST((fvg_high - fvg_low) * 10000 AS DECIMAL(10,2)) AS fvg_size_pips,
           open, high, low, close
    FROM {name}_lv WHERE fvg_type IS NOT NULL)"""


def close_fill_cte(name: str, src: str) -> str:
    return f"""{name} AS (
    SELECT *, CASE WHEN fvg_type = 'bullish' AND close <= fvg_high THEN 1
                   WHEN fvg_type = 'bearish' AND close >= fvg_low THEN 1
                   ELSE 0 END AS is_filled
    FROM {src})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [EV_BARS, bronze_cte("bronze")]
SILVER = BASE + [silver_ctes("bronze")]
GOLD = SILVER + [gap_ctes(), close_fill_cte("gold", "gaps")]
REPLAY = bronze_cte("replay_all", factor=2, shift_days=1)
REPLAY_CTE = f"replay AS (SELECT * FROM replay_all WHERE date >= '{UPSERT_INCOMING_FROM}')"
MALFORMED = [EV_BARS, bronze_cte("bronze_m", malformed=True)]
BUILD_SILVER = MALFORMED + [REPLAY, REPLAY_CTE,
                            f"mixed AS (SELECT * FROM bronze_m UNION ALL SELECT * FROM replay)",
                            silver_ctes("mixed")]
RUN_TS_SQL = f"TIMESTAMP '{RUN_TS}'"


def _vol_cte(src: str = "silver") -> str:
    # Spark: avg(decimal(10,5)) -> decimal(14,9) half-up, then round(.., 5) half-up
    return f"""vol AS (
    SELECT * EXCLUDE (s, n, a9),
           CAST(((a9 * 2 + 10000) // 20000) * 0.00001 AS DECIMAL(10,5)) AS volatility_20d
    FROM (SELECT *, (2 * s * 10000 + n) // (2 * n) AS a9
          FROM (SELECT *,
                       SUM(CAST(daily_range * 100000 AS HUGEINT)) OVER w AS s,
                       COUNT(*) OVER w AS n
                FROM {src}
                WINDOW w AS ({W_PAIR} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))))"""


def _future_cte() -> str:
    return f"""fut AS (
    SELECT *, MIN(low) OVER ({W_PAIR} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS future_low,
              MAX(high) OVER ({W_PAIR} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS future_high
    FROM silver)"""


FUTURE_FILLED = """CASE WHEN fvg_type = 'bullish' AND future_low <= fvg_low THEN 1
                        WHEN fvg_type = 'bearish' AND future_high >= fvg_high THEN 1
                        ELSE 0 END"""

ORACLE_SQL: dict[str, str] = {}

# -- gap detection -------------------------------------------------------------
ORACLE_SQL["neighbour_bars"] = with_(*SILVER, gap_ctes()) + (
    f"SELECT {SILVER_COLS}, prev_high, prev_low, next_high, next_low FROM gaps_nb")
ORACLE_SQL["detect_gaps"] = with_(*SILVER, gap_ctes()) + "SELECT * FROM gaps"
ORACLE_SQL["detect_bullish"] = with_(*SILVER, gap_ctes()) + (
    "SELECT * FROM gaps WHERE fvg_type = 'bullish'")
ORACLE_SQL["detect_bearish"] = with_(*SILVER, gap_ctes()) + (
    "SELECT * FROM gaps WHERE fvg_type = 'bearish'")
ORACLE_SQL["detect_gaps_positional"] = with_(*SILVER, gap_ctes(levels="positional")) + (
    "SELECT * FROM gaps")
ORACLE_SQL["detect_gaps_union"] = ORACLE_SQL["detect_gaps"]
ORACLE_SQL["gap_size_pips"] = with_(*SILVER, gap_ctes()) + (
    "SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low, fvg_size_pips FROM gaps")
ORACLE_SQL["gap_fill_close"] = with_(*GOLD) + "SELECT * FROM gold"
ORACLE_SQL["gap_fill_close_positional"] = with_(
    *SILVER, gap_ctes(levels="positional"), close_fill_cte("gold", "gaps")) + "SELECT * FROM gold"
ORACLE_SQL["gap_fill_future"] = with_(*SILVER, _future_cte(), gap_ctes("fut", "fg")) + f"""
SELECT g.*, {FUTURE_FILLED} AS is_filled
FROM fg g JOIN fut USING (date, from_symbol, to_symbol)"""
ORACLE_SQL["gap_first_fill"] = with_(
    *SILVER, gap_ctes(),
    f"numbered AS (SELECT *, ROW_NUMBER() OVER ({W_PAIR}) AS rn FROM silver)",
    f"""gnum AS (SELECT g.*, n.rn FROM gaps g JOIN numbered n USING (date, from_symbol, to_symbol))""",
    """first_fill AS (
    SELECT g.from_symbol, g.to_symbol, g.date, MIN(b.rn) AS fill_rn, MIN(b.date) AS first_fill_date
    FROM gnum g JOIN numbered b
      ON b.from_symbol = g.from_symbol AND b.to_symbol = g.to_symbol AND b.rn > g.rn
     AND ((g.fvg_type = 'bullish' AND b.low <= g.fvg_low)
       OR (g.fvg_type = 'bearish' AND b.high >= g.fvg_high))
    GROUP BY 1, 2, 3)""") + f"""
SELECT {', '.join('g.' + c.strip() for c in GAP_COLS.split(','))},
       CASE WHEN f.first_fill_date IS NULL THEN 0 ELSE 1 END AS is_filled,
       f.first_fill_date,
       CAST(f.fill_rn - g.rn AS INTEGER) AS bars_to_fill,
       CAST(date_diff('day', g.date, f.first_fill_date) AS INTEGER) AS days_to_fill
FROM gnum g LEFT JOIN first_fill f USING (date, from_symbol, to_symbol)"""

# -- silver ---------------------------------------------------------------------
ORACLE_SQL["cast_bars"] = with_(*MALFORMED, typed_cte("typed", "bronze_m")) + "SELECT * FROM typed"
ORACLE_SQL["clean_bars"] = with_(*MALFORMED, typed_cte("typed", "bronze_m")) + (
    f"SELECT * FROM typed WHERE {GOOD}")
ORACLE_SQL["rejected_bars"] = with_(*MALFORMED, typed_cte("typed", "bronze_m")) + (
    f"SELECT * FROM (SELECT *, {REASON} AS reject_reason FROM typed) "
    "WHERE reject_reason IS NOT NULL")
_wl = ", ".join(f"'{s}'" for s in WHITELIST)
ORACLE_SQL["valid_symbols"] = with_(*SILVER) + (
    f"SELECT * FROM silver WHERE from_symbol IN ({_wl}) AND to_symbol IN ({_wl})")
ORACLE_SQL["dedup_latest"] = with_(
    f"""copies AS (
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, v AS open, v AS high, v AS low, v AS close,
           'U' || CAST(user_id AS VARCHAR) AS from_symbol, 'USD' AS to_symbol,
           ts AS _ingest_timestamp, 'event:' || CAST(event_id AS VARCHAR) AS _source
    FROM (SELECT *, {_txt('value')} AS v FROM events))""",
    dedup_cte("dd", "copies")) + "SELECT * FROM dd"
ORACLE_SQL["daily_range"] = with_(*BASE, typed_cte("typed", "bronze")) + (
    f"SELECT *, CAST(high - low AS DECIMAL(10,5)) AS daily_range FROM typed WHERE {GOOD}")
ORACLE_SQL["daily_return"] = with_(
    *BASE, typed_cte("typed", "bronze"), f"clean AS (SELECT * FROM typed WHERE {GOOD})",
    derive_cte("derived", "clean")) + "SELECT * FROM derived"
ORACLE_SQL["build_silver"] = with_(*BUILD_SILVER) + "SELECT * FROM silver"

# -- reports --------------------------------------------------------------------
ORACLE_SQL["report_gaps_by_size"] = with_(*GOLD) + """
SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low,
       ABS(fvg_size_pips) AS fvg_size_pips, is_filled,
       CASE WHEN is_filled = 1 THEN 'Filled' ELSE 'Active' END AS status
FROM gold"""
ORACLE_SQL["report_active_gaps"] = with_(*GOLD) + """
SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low,
       ABS(fvg_size_pips) AS fvg_size_pips
FROM gold WHERE is_filled = 0"""
ORACLE_SQL["report_fill_rate"] = with_(*GOLD) + """
SELECT fvg_type, total_fvgs, filled_count, total_fvgs - filled_count AS unfilled_count,
       CAST(((filled_count * 20000 + total_fvgs) // (2 * total_fvgs)) * 0.01
            AS DECIMAL(5,2)) AS fill_rate_pct
FROM (SELECT fvg_type, COUNT(*) AS total_fvgs, CAST(SUM(is_filled) AS BIGINT) AS filled_count
      FROM gold GROUP BY fvg_type)"""
_SPREAD = [EV_BARS, bronze_cte("bronze", spread=True), silver_ctes("bronze"), gap_ctes(),
           close_fill_cte("gold", "gaps")]
ORACLE_SQL["report_monthly_activity"] = with_(*_SPREAD) + """
SELECT from_symbol, to_symbol, month, total_fvgs, bullish_fvgs, bearish_fvgs,
       CAST(((((2 * cents * 10000 + total_fvgs) // (2 * total_fvgs)) * 2 + 10000) // 20000) * 0.01
            AS DECIMAL(10,2)) AS avg_size_pips,
       max_size_pips
FROM (SELECT from_symbol, to_symbol, date_trunc('month', date) AS month,
             COUNT(*) AS total_fvgs,
             CAST(SUM(CASE WHEN fvg_type = 'bullish' THEN 1 ELSE 0 END) AS BIGINT) AS bullish_fvgs,
             CAST(SUM(CASE WHEN fvg_type = 'bearish' THEN 1 ELSE 0 END) AS BIGINT) AS bearish_fvgs,
             SUM(CAST(ABS(fvg_size_pips) * 100 AS HUGEINT)) AS cents,
             CAST(MAX(ABS(fvg_size_pips)) AS DECIMAL(10,2)) AS max_size_pips
      FROM gold GROUP BY 1, 2, 3)"""
ORACLE_SQL["rolling_volatility"] = with_(*SILVER, _vol_cte()) + "SELECT * FROM vol"
ORACLE_SQL["report_volatility"] = with_(*GOLD, _vol_cte()) + """
SELECT v.date, v.from_symbol, v.to_symbol, v.daily_range, v.volatility_20d, v.daily_return,
       g.fvg_type, ABS(g.fvg_size_pips) AS fvg_size_pips
FROM vol v LEFT JOIN gold g USING (date, from_symbol, to_symbol)"""
_MOVE_COLS = "date, from_symbol, to_symbol, open, high, low, close, daily_range, daily_return"
ORACLE_SQL["report_largest_moves"] = with_(*SILVER) + f"""
SELECT {_MOVE_COLS}, CAST(move_rank AS INTEGER) AS move_rank
FROM (SELECT *, RANK() OVER (ORDER BY ABS(daily_return) DESC NULLS LAST) AS move_rank FROM silver)
WHERE move_rank <= {TOP}"""
ORACLE_SQL["largest_moves_per_pair"] = with_(*SILVER) + f"""
SELECT {_MOVE_COLS}, CAST(move_rank AS INTEGER) AS move_rank
FROM (SELECT *, RANK() OVER (PARTITION BY {PAIR} ORDER BY ABS(daily_return) DESC NULLS LAST)
             AS move_rank FROM silver)
WHERE move_rank <= {TOP}"""
ORACLE_SQL["gap_summary"] = with_(*GOLD) + """
SELECT COUNT(*) AS total_fvgs,
       COUNT(*) FILTER (WHERE fvg_type = 'bullish') AS bullish_fvgs,
       COUNT(*) FILTER (WHERE fvg_type = 'bearish') AS bearish_fvgs,
       COUNT(*) FILTER (WHERE is_filled = 1) AS filled_fvgs,
       COUNT(*) FILTER (WHERE is_filled = 0) AS unfilled_fvgs
FROM gold"""
ORACLE_SQL["largest_gaps"] = with_(*GOLD) + f"""
SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low, fvg_size_pips, is_filled
FROM gold ORDER BY ABS(fvg_size_pips) DESC, from_symbol, to_symbol, date LIMIT {TOP}"""
ORACLE_SQL["latest_active_gaps"] = with_(*GOLD) + f"""
SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low, fvg_size_pips
FROM gold WHERE is_filled = 0 ORDER BY date DESC, from_symbol, to_symbol LIMIT {TOP}"""
ORACLE_SQL["latest_bars"] = with_(*SILVER) + f"""
SELECT {_MOVE_COLS} FROM silver ORDER BY date DESC, from_symbol, to_symbol LIMIT {TOP}"""
ORACLE_SQL["last_bar_date"] = with_(*SILVER) + f"""
SELECT {PAIR}, MAX(date) AS last_date, COUNT(*) AS n_bars FROM silver GROUP BY {PAIR}"""

# -- sources and sinks -------------------------------------------------------------
ORACLE_SQL["classify_documents"] = with_(EV_BARS) + f"""
SELECT CASE WHEN k = 0 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS from_symbol,
       CASE WHEN k = 0 THEN NULL ELSE 'USD' END AS to_symbol,
       CASE WHEN k IN (0, 2) THEN 'rejected' WHEN k = 1 THEN 'warning' ELSE 'accepted' END
           AS status,
       CASE WHEN k = 0 THEN 'error: Invalid API call for U' || CAST(user_id AS VARCHAR)
            WHEN k = 2 THEN 'missing time series'
            WHEN k = 1 THEN 'note: {NOTE_TEXT}' END AS reason,
       CAST(CASE WHEN k IN (0, 2) THEN 0 ELSE n END AS INTEGER) AS n_days
FROM (SELECT user_id, user_id % 10 AS k, COUNT(*) AS n FROM ev_bars GROUP BY user_id)"""
ORACLE_SQL["flatten_documents"] = with_(*BASE) + f"""
SELECT date, open, high, low, close, from_symbol, to_symbol,
       {RUN_TS_SQL} AS _ingest_timestamp, 'events' AS _source
FROM bronze WHERE CAST(substr(from_symbol, 2) AS BIGINT) % 10 NOT IN (0, 2)"""
_WITH_PAIR = "SELECT *, upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM {src}"
ORACLE_SQL["write_raw_json"] = with_(*BASE) + _WITH_PAIR.format(src="bronze")
ORACLE_SQL["scan_raw_json"] = ORACLE_SQL["write_raw_json"]
ORACLE_SQL["scan_bars"] = with_(*SILVER) + _WITH_PAIR.format(src="silver")
ORACLE_SQL["load_bronze"] = with_(*BASE) + f"""
SELECT date, open, high, low, close, from_symbol, to_symbol,
       {RUN_TS_SQL} AS _ingest_timestamp, _source,
       upper(from_symbol) || '_' || upper(to_symbol) AS pair
FROM bronze"""
ORACLE_SQL["write_layer"] = with_(*GOLD) + f"""
SELECT *, {RUN_TS_SQL} AS _updated_at, upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM gold"""
ORACLE_SQL["build_gold"] = with_(*GOLD) + f"SELECT *, {RUN_TS_SQL} AS _updated_at FROM gold"
ORACLE_SQL["upsert_bars"] = with_(*BASE, REPLAY, REPLAY_CTE) + f"""
SELECT * FROM replay
UNION ALL
SELECT e.* FROM bronze e
WHERE e.date <= '{UPSERT_EXISTING_UNTIL}'
  AND NOT EXISTS (SELECT 1 FROM replay r WHERE r.date = e.date
                  AND r.from_symbol = e.from_symbol AND r.to_symbol = e.to_symbol)"""
ORACLE_SQL["evolve_schema"] = with_(*BASE, REPLAY, REPLAY_CTE) + f"""
SELECT {BRONZE_COLS}, CAST(NULL AS VARCHAR) AS _batch_note,
       upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM bronze
UNION ALL
SELECT {BRONZE_COLS}, 'replay' AS _batch_note,
       upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM replay"""
ORACLE_SQL["conform_layer"] = with_(*SILVER) + "SELECT * FROM silver"
ORACLE_SQL["layer_row_counts"] = with_(*BUILD_SILVER, gap_ctes()) + """
SELECT 'bronze' AS layer, COUNT(*) AS n_rows FROM mixed
UNION ALL SELECT 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'gold', COUNT(*) FROM gaps"""
ORACLE_SQL["stream_refresh"] = with_(
    *BASE, REPLAY, REPLAY_CTE,
    """merged AS (
    SELECT * FROM replay
    UNION ALL
    SELECT e.* FROM bronze e
    WHERE NOT EXISTS (SELECT 1 FROM replay r WHERE r.date = e.date
                      AND r.from_symbol = e.from_symbol AND r.to_symbol = e.to_symbol))""",
    silver_ctes("merged"), gap_ctes(), close_fill_cte("gold", "gaps")) + """
SELECT *, upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM gold"""

# the Spark SQL texts of the reports: same oracles (monthly activity without
# the spread dates, so its oracle is built on the plain bars)
ORACLE_SQL["sql_report_gaps_by_size"] = ORACLE_SQL["report_gaps_by_size"]
ORACLE_SQL["sql_report_active_gaps"] = ORACLE_SQL["report_active_gaps"]
ORACLE_SQL["sql_report_fill_rate"] = ORACLE_SQL["report_fill_rate"]
ORACLE_SQL["sql_report_volatility"] = ORACLE_SQL["report_volatility"]
ORACLE_SQL["sql_report_largest_moves"] = ORACLE_SQL["report_largest_moves"]
ORACLE_SQL["sql_report_monthly_activity"] = ORACLE_SQL["report_monthly_activity"].replace(
    bronze_cte("bronze", spread=True), bronze_cte("bronze"))
ORACLE_SQL["ingest_documents"] = (
    "SELECT *, upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM ("
    + ORACLE_SQL["flatten_documents"] + ")")
ORACLE_SQL["report_fill_rate_positional"] = ORACLE_SQL["report_fill_rate"].replace(
    gap_ctes(), gap_ctes(levels="positional"))
ORACLE_SQL["load_bronze_merge"] = with_(*BASE, REPLAY, REPLAY_CTE) + f"""
SELECT date, open, high, low, close, from_symbol, to_symbol,
       TIMESTAMP '{RUN_TS_2}' AS _ingest_timestamp, _source,
       upper(from_symbol) || '_' || upper(to_symbol) AS pair
FROM replay
UNION ALL
SELECT date, open, high, low, close, from_symbol, to_symbol,
       {RUN_TS_SQL} AS _ingest_timestamp, _source,
       upper(from_symbol) || '_' || upper(to_symbol) AS pair
FROM bronze e
WHERE NOT EXISTS (SELECT 1 FROM replay r WHERE r.date = e.date
                  AND r.from_symbol = e.from_symbol AND r.to_symbol = e.to_symbol)"""
ORACLE_SQL["report_monthly_activity_all"] = with_(*_SPREAD) + """
SELECT month, total_fvgs, bullish_fvgs, bearish_fvgs,
       CAST(((((2 * cents * 10000 + total_fvgs) // (2 * total_fvgs)) * 2 + 10000) // 20000) * 0.01
            AS DECIMAL(10,2)) AS avg_size_pips,
       max_size_pips
FROM (SELECT date_trunc('month', date) AS month,
             COUNT(*) AS total_fvgs,
             CAST(SUM(CASE WHEN fvg_type = 'bullish' THEN 1 ELSE 0 END) AS BIGINT) AS bullish_fvgs,
             CAST(SUM(CASE WHEN fvg_type = 'bearish' THEN 1 ELSE 0 END) AS BIGINT) AS bearish_fvgs,
             SUM(CAST(ABS(fvg_size_pips) * 100 AS HUGEINT)) AS cents,
             CAST(MAX(ABS(fvg_size_pips)) AS DECIMAL(10,2)) AS max_size_pips
      FROM gold GROUP BY 1)"""
ORACLE_SQL["null_violations"] = with_(*MALFORMED, typed_cte("typed", "bronze_m")) + """
SELECT COUNT(*) FILTER (WHERE date IS NULL) AS null_date,
       COUNT(*) FILTER (WHERE open IS NULL) AS null_open,
       COUNT(*) FILTER (WHERE high IS NULL) AS null_high,
       COUNT(*) FILTER (WHERE low IS NULL) AS null_low,
       COUNT(*) FILTER (WHERE close IS NULL) AS null_close,
       COUNT(*) FILTER (WHERE from_symbol IS NULL) AS null_from_symbol,
       COUNT(*) FILTER (WHERE to_symbol IS NULL) AS null_to_symbol
FROM typed"""
ORACLE_SQL["latest_bronze_bars"] = with_(*BASE) + """
SELECT date, from_symbol, to_symbol, open, high, low, close
FROM bronze ORDER BY date DESC, from_symbol, to_symbol LIMIT 5"""
ORACLE_SQL["largest_gaps_positional"] = with_(
    *SILVER, gap_ctes(levels="positional"), close_fill_cte("gold", "gaps")) + f"""
SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low, fvg_size_pips, is_filled
FROM gold ORDER BY fvg_size_pips DESC, from_symbol, to_symbol, date LIMIT {TOP}"""
ORACLE_SQL["gap_summary_positional"] = ORACLE_SQL["gap_summary"].replace(
    gap_ctes(), gap_ctes(levels="positional"))
ORACLE_SQL["report_gaps_by_size_positional"] = ORACLE_SQL["report_gaps_by_size"].replace(
    gap_ctes(), gap_ctes(levels="positional"))
ORACLE_SQL["report_active_gaps_positional"] = ORACLE_SQL["report_active_gaps"].replace(
    gap_ctes(), gap_ctes(levels="positional"))
ORACLE_SQL["last_date"] = with_(*SILVER) + "SELECT MAX(date) AS last_date FROM silver"
ORACLE_SQL["report_volatility_join"] = ORACLE_SQL["report_volatility"]
ORACLE_SQL["rebuild_after_correction"] = with_(*GOLD) + """
SELECT date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low, fvg_size_pips, is_filled
FROM gold WHERE CAST(SUBSTR(from_symbol, 2) AS BIGINT) % 2 = 1"""
_ONE = f"from_symbol = '{ONE_PAIR[0]}' AND to_symbol = '{ONE_PAIR[1]}'"
ORACLE_SQL["scan_one_pair"] = ORACLE_SQL["scan_bars"] + f" WHERE {_ONE}"
ORACLE_SQL["run_one_pair"] = ORACLE_SQL["write_layer"] + f" WHERE {_ONE}"
_REJECTED = f"""refused AS (
    SELECT * EXCLUDE (d, o, h, l, c), upper(from_symbol) || '_' || upper(to_symbol) AS pair,
           {re.sub(r"\b(date|open|high|low|close)\b(?!')", lambda m: m[1][0], REASON)} AS reject_reason
    FROM (SELECT *, TRY_CAST(date AS DATE) AS d, TRY_CAST(open AS DECIMAL(10,5)) AS o,
                 TRY_CAST(high AS DECIMAL(10,5)) AS h, TRY_CAST(low AS DECIMAL(10,5)) AS l,
                 TRY_CAST(close AS DECIMAL(10,5)) AS c FROM mixed))"""
ORACLE_SQL["silver_rejects"] = with_(*BUILD_SILVER, _REJECTED) + "SELECT * FROM refused WHERE reject_reason IS NOT NULL"
ORACLE_SQL["silver_run_counts"] = with_(*BUILD_SILVER) + f"""
SELECT 'read' AS point, COUNT(*) AS n_rows FROM mixed
UNION ALL SELECT 'rejected', COUNT(*) FROM silver_typed WHERE NOT ({GOOD}) OR ({GOOD}) IS NULL
UNION ALL SELECT 'unique', COUNT(*) FROM silver
UNION ALL SELECT 'violating', COUNT(*) FROM silver WHERE from_symbol IS NULL OR to_symbol IS NULL OR daily_range IS NULL
UNION ALL SELECT 'written', COUNT(*) FROM silver
    WHERE from_symbol IS NOT NULL AND to_symbol IS NOT NULL AND daily_range IS NOT NULL"""

_REFRESHED = ORACLE_SQL["stream_refresh"].split("\nSELECT *, upper(from_symbol)")[0]
ORACLE_SQL["refresh_gold"] = ORACLE_SQL["stream_refresh"]
ORACLE_SQL["refresh_silver"] = _REFRESHED + """
SELECT * EXCLUDE (_ingest_timestamp), upper(from_symbol) || '_' || upper(to_symbol) AS pair FROM silver"""
for _report, _plain in (("state_fill_rate", "report_fill_rate"), ("state_summary", "gap_summary")):
    ORACLE_SQL[_report] = _REFRESHED + ORACLE_SQL[_plain].split(close_fill_cte("gold", "gaps"))[1]
ORACLE_SQL["state_monthly_activity"] = _REFRESHED + ORACLE_SQL["report_monthly_activity"].split(
    close_fill_cte("gold", "gaps"))[1]
ORACLE_SQL["volatility_since"] = with_(*SILVER, _vol_cte()) + f"""
SELECT * FROM vol v WHERE date >= (
    SELECT MIN(CAST(date AS DATE)) FROM bronze s WHERE s.date >= '{UPSERT_INCOMING_FROM}'
      AND s.from_symbol = v.from_symbol AND s.to_symbol = v.to_symbol)"""

for _name in ("neighbour_bars", "detect_gaps", "gap_fill_future", "daily_return", "rolling_volatility", "gap_first_fill"):
    ORACLE_SQL[f"{_name}_blocks"] = ORACLE_SQL[_name]

ORACLE_SQL["report_largest_moves_in_parallel"] = ORACLE_SQL["report_largest_moves"]
for _name, _order in ORDERS.items():
    _by = ", ".join(f"{c[1:]} DESC NULLS LAST" if c.startswith("-") else f"{c} NULLS FIRST" for c in _order)
    _report = "sql_report_monthly_activity" if _name == "report_monthly_activity" else _name
    ORACLE_SQL[f"position_{_name}"] = f"SELECT *, row_number() OVER (ORDER BY {_by}) AS position FROM ({ORACLE_SQL[_report]})"
ORACLE_SQL["raw_file_order"] = with_(*BASE) + f"""
SELECT date, from_symbol, to_symbol, row_number() OVER ({W_PAIR}) AS position FROM bronze"""
