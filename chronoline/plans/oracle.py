"""DuckDB SQL that computes what each plan in :mod:`chronoline.plans.catalog`
computes, on the same Parquet tables (views ``events``, ``orders``, ``lineitem``).

Written independently of the Spark code: series keys by string concatenation,
nanoseconds from ``epoch_us``, slices and cursors by integer arithmetic, upsert
by ``row_number()``.  All times here are >= 1970, where DuckDB's truncating
``//`` equals floor division; pre-1970 values use an explicit positive modulo.
"""

from __future__ import annotations

from chronoline.plans import catalog as C

EV_T = "(epoch_us(ts) * 1000)"
EV_KEY = "('events,event_type=' || event_type || ',user_id=' || CAST(user_id AS VARCHAR))"
O_T = "(epoch_us(o_orderdate) * 1000)"
LI_T = "(epoch_us(l_shipdate) * 1000)"
LI_KEY = "('lineitem,l_linestatus=' || l_linestatus || ',l_returnflag=' || l_returnflag)"


def _esc(x: str) -> str:
    """Tag/field-key escaping in SQL: backslash, comma, equals sign, space."""
    return (f"replace(replace(replace(replace({x}, '\\', '\\\\'), ',', '\\,'), '=', '\\='), "
            f"' ', '\\ ')")


O_KEY = (f"('orders,o_orderpriority=' || {_esc('o_orderpriority')} || ',o_orderstatus=' || "
         f"{_esc('o_orderstatus')})")

EV = f"(SELECT {EV_KEY} AS k, {EV_T} AS t, ts, value, event_id, props FROM events WHERE value IS NOT NULL) ev"
A, B = C.RANGE_START_NS, C.RANGE_STOP_NS
N = C.N_SLICES

# A line's grammar, in SQL's regular expressions: names with backslash escapes; a
# value is quoted or has no comma, quote or space; the time is optional.
_SQL_NAME, _SQL_VALUE = r"([^,= \\]|\\.)+", r'("([^"\\]|\\.)*"|[^," ]+)'
_SQL_LINE = (rf"([^, \\]|\\.)+(,{_SQL_NAME}={_SQL_NAME})* {_SQL_NAME}={_SQL_VALUE}(,{_SQL_NAME}={_SQL_VALUE})*"
             r"( -?[0-9]+)?")

_LI_WINNER = (
    "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, "
    "l_shipdate ORDER BY " + ", ".join(f"{c} DESC" for c in C.LINEITEM_ORDER)
    + ") AS rn FROM lineitem) WHERE rn = 1) w")

_ISO_FRAC = (
    "CASE WHEN t % 1000000000 = 0 THEN '' "
    "WHEN t % 1000000 = 0 THEN '.' || lpad(CAST((t % 1000000000) // 1000000 AS VARCHAR), 3, '0') "
    "WHEN t % 1000 = 0 THEN '.' || lpad(CAST((t % 1000000000) // 1000 AS VARCHAR), 6, '0') "
    "ELSE '.' || lpad(CAST(t % 1000000000 AS VARCHAR), 9, '0') END")


def _floor_div(x: str, k: int) -> str:
    return f"(({x}) - ((({x}) % {k}) + {k}) % {k}) // {k}"


def _pmod(x: str, k: int) -> str:
    return f"(((({x}) % {k}) + {k}) % {k})"


NEG = f"(t - {20_000 * 86_400_000_000_000})"

ORACLE_SQL = {
    "range_scan": f"""
        SELECT k AS series_key, 'value' AS field, value AS value_double, t AS time_ns
        FROM {EV} WHERE t >= {A} AND t < {B}""",
    "first_last_time": f"""
        SELECT min(t) AS first_ns, max(t) AS last_ns, count(*) AS n_records FROM {EV}""",
    "series_stats": f"""
        SELECT k AS series_key, 'value' AS field, count(*) AS n_records,
               min(t) AS first_ns, max(t) AS last_ns
        FROM {EV} GROUP BY k""",
    "series_cardinality": f"""
        SELECT 'events' AS measurement, count(DISTINCT k) AS n_series,
               count(DISTINCT field) AS n_fields
        FROM (SELECT {EV_KEY} AS k, 'value' AS field FROM events WHERE value IS NOT NULL
              UNION ALL
              SELECT {EV_KEY} AS k, 'props' AS field FROM events WHERE props IS NOT NULL) u""",
    "first_last_record": f"""
        SELECT k AS series_key, 'value' AS field, min(t) AS first_ns,
               arg_min(value, t) AS first_value, max(t) AS last_ns, arg_max(value, t) AS last_value
        FROM {EV} GROUP BY k""",
    "range_count": f"""
        SELECT (SELECT count(*) FROM {EV} WHERE t >= {A} AND t < {B}) AS n_records,
               (SELECT count(*) FROM (SELECT DISTINCT k, t FROM {EV}
                                      WHERE t >= {A} AND t < {B}) d) AS n_points""",
    "range_count_by_series": f"""
        SELECT k AS series_key, count(*) AS n_records, count(DISTINCT t) AS n_points
        FROM {EV} WHERE t >= {A} AND t < {B} GROUP BY k""",
    "time_slices": f"""
        WITH b AS (SELECT min(t) AS lo, max(t) + 1 AS hi FROM {EV})
        SELECT CAST(i AS INTEGER) AS slice_id, lo + i * ((hi - lo) // {N}) AS start_ns,
               CASE WHEN i = {N - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) // {N}) END AS stop_ns
        FROM b, range(0, {N}) AS r(i)""",
    "slice_counts": f"""
        WITH b AS (SELECT min(t) AS lo, max(t) + 1 AS hi, (max(t) + 1 - min(t)) // {N} AS w FROM {EV})
        SELECT CAST(CASE WHEN w = 0 THEN {N - 1} ELSE least((t - lo) // w, {N - 1}) END AS INTEGER)
                   AS slice_id,
               count(*) AS n_records, min(t) AS first_ns, max(t) AS last_ns
        FROM {EV}, b GROUP BY 1""",
    "incremental_batches": f"""
        WITH b AS (SELECT min(t) AS lo FROM {EV})
        SELECT (t - lo) // {C.BATCH_DELTA_NS} AS batch,
               lo + ((t - lo) // {C.BATCH_DELTA_NS}) * {C.BATCH_DELTA_NS} AS batch_start_ns,
               lo + ((t - lo) // {C.BATCH_DELTA_NS} + 1) * {C.BATCH_DELTA_NS} AS batch_end_ns,
               count(*) AS n_records, min(t) AS first_ns, max(t) AS last_ns
        FROM {EV}, b GROUP BY 1, 2, 3""",
    "tail_held": f"""
        WITH b AS (SELECT min(t) AS lo, max(t) AS hi FROM {EV})
        SELECT k AS series_key, 'value' AS field, value AS value_double, t AS time_ns
        FROM {EV}, b
        WHERE t >= lo + ((hi - lo + {C.TAIL_DELTA_NS - 1}) // {C.TAIL_DELTA_NS}) * {C.TAIL_DELTA_NS}""",
    "late_rows": f"""
        WITH e AS (SELECT t, CAST((event_id * {C.ARRIVAL_MULTIPLIER}) % {C.ARRIVAL_BATCHES} AS INTEGER)
                          AS arrival_batch FROM {EV}),
             pb AS (SELECT arrival_batch, max(t) AS mx FROM e GROUP BY arrival_batch),
             cur AS (SELECT arrival_batch,
                            max(mx) OVER (ORDER BY arrival_batch
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1
                                AS cursor_ns
                     FROM pb)
        SELECT e.arrival_batch, count(*) AS n_rows, cur.cursor_ns,
               CAST(coalesce(sum(CASE WHEN cur.cursor_ns IS NOT NULL AND t < cur.cursor_ns
                                      THEN 1 END), 0) AS BIGINT) AS n_late
        FROM e JOIN cur ON e.arrival_batch = cur.arrival_batch
        GROUP BY e.arrival_batch, cur.cursor_ns""",
    "encode_compat": f"""
        SELECT k || ' value=' || CAST(value AS VARCHAR) || ' ' || CAST(t AS VARCHAR) AS value
        FROM {EV}""",
    "encode_safe": f"""
        SELECT {O_KEY} || ' o_totalprice=' || CAST(o_totalprice AS VARCHAR) || ' '
               || CAST({O_T} AS VARCHAR) AS value FROM orders WHERE o_totalprice IS NOT NULL
        UNION ALL
        SELECT {O_KEY} || ' o_custkey=' || CAST(o_custkey AS VARCHAR) || 'i '
               || CAST({O_T} AS VARCHAR) AS value FROM orders WHERE o_custkey IS NOT NULL""",
    "encode_wide": f"""
        SELECT {EV_KEY} || ' props="' || replace(replace(props, '\\', '\\\\'), '"', '\\"')
               || '",value=' || CAST(value AS VARCHAR) || ' ' || CAST({EV_T} AS VARCHAR) AS value
        FROM events""",
    "decode_lines": f"""
        SELECT 'orders' AS measurement, o_orderstatus, o_orderpriority, {O_KEY} AS series_key,
               'o_totalprice' AS field, o_totalprice AS value_double,
               CAST(NULL AS BIGINT) AS value_long, {O_T} AS time_ns
        FROM orders WHERE o_totalprice IS NOT NULL
        UNION ALL
        SELECT 'orders' AS measurement, o_orderstatus, o_orderpriority, {O_KEY} AS series_key,
               'o_custkey' AS field, CAST(NULL AS DOUBLE) AS value_double,
               o_custkey AS value_long, {O_T} AS time_ns
        FROM orders WHERE o_custkey IS NOT NULL""",
    "bad_lines": f"""
        SELECT line AS value, 'syntax' AS reason
        FROM (SELECT {EV_KEY} || ' value=' || CAST(value AS VARCHAR) || ' '
                     || CAST({EV_T} AS VARCHAR) AS line FROM events WHERE value IS NOT NULL
              UNION ALL
              SELECT {EV_KEY} || ' props=' || props || ' ' || CAST({EV_T} AS VARCHAR) AS line
              FROM events WHERE props IS NOT NULL) l
        WHERE NOT regexp_full_match(line, '{_SQL_LINE}')""",
    "upsert_long": f"""
        SELECT k AS series_key, 'value' AS field, d AS time_ns, value AS value_double
        FROM (SELECT k, t - t % 86400000000000 AS d, value, row_number() OVER (
                PARTITION BY k, t - t % 86400000000000 ORDER BY event_id DESC) AS rn FROM {EV})
        WHERE rn = 1""",
    "bad_line_reasons": """
        SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'null' WHEN 1 THEN 'empty' WHEN 2 THEN 'comment'
            WHEN 3 THEN 'syntax' WHEN 4 THEN 'duplicate tag key' WHEN 5 THEN 'duplicate field key'
            WHEN 6 THEN 'bad value' WHEN 7 THEN 'time out of range' ELSE 'bad value' END AS reason
        FROM events WHERE event_id % 10 < 9""",
    "bad_points": """
        SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'no value' ELSE 'not a finite number' END AS reason
        FROM events WHERE value IS NOT NULL AND event_id % 4 <> 2""",
    "balanced_slices": f"""
        SELECT i::INTEGER AS slice_id, (SELECT count(*) FROM events WHERE value IS NOT NULL) AS n_all,
               true AS within_tolerance
        FROM range({N}) r(i)""",
    "wide_map": f"""
        SELECT series_key, time_ns, concat_ws(',', 'props=' || p, 'value=' || v) AS fields
        FROM (SELECT {EV_KEY} AS series_key, {EV_T} AS time_ns, max(props) AS p,
                     max(CAST(value AS VARCHAR)) AS v
              FROM events WHERE props IS NOT NULL OR value IS NOT NULL GROUP BY 1, 2)""",
    "store_coalesced": f"""
        SELECT k AS series_key, 'value' AS field,
               CASE WHEN t >= {A} AND t < {B} THEN -v ELSE v END AS value_double, t AS time_ns
        FROM (SELECT {EV_KEY} AS k, {EV_T} AS t, max(value) AS v FROM events WHERE value IS NOT NULL GROUP BY 1, 2)""",
    "stream_late_drain": f"""
        SELECT count(*) FILTER (WHERE t >= {A}) AS n_read, count(*) FILTER (WHERE t < {A}) AS n_late FROM {EV}""",
    "stream_tail_drain": f"""
        SELECT k AS series_key, d AS time_ns, value AS value_double
        FROM (SELECT k, t - t % 86400000000000 AS d, value, row_number() OVER (
                PARTITION BY k, t - t % 86400000000000 ORDER BY event_id DESC) AS rn FROM {EV})
        WHERE rn = 1 AND d < (SELECT max(t - t % 86400000000000) FROM {EV})""",
    "stream_gap_drain": """
        SELECT row_number() OVER (ORDER BY t) AS step, epoch_us(t::TIMESTAMP) * 1000 AS time_ns, n_orders, sum_price
        FROM (SELECT date_trunc('year', o_orderdate) AS t, count(*) AS n_orders,
                     round(sum(o_totalprice), 2) AS sum_price FROM orders GROUP BY 1)""",
    "stream_capped_drain": f"""
        SELECT k AS series_key, 'value' AS field, value AS value_double, t AS time_ns FROM {EV}""",
    "ns_parts": f"""
        SELECT event_id, t AS time_ns, t // 1000000000 AS seconds, t % 1000000000 AS nanos,
               {NEG} AS neg_ns, {_floor_div(NEG, 1_000_000_000)} AS neg_seconds,
               {_pmod(NEG, 1_000_000_000)} AS neg_nanos,
               {_floor_div(NEG, 1000)} AS neg_us, {NEG} AS neg_back_ns
        FROM {EV}""",
    "ns_add": f"""
        SELECT event_id, t + 90 * 60000000000 AS plus_90min, t - 2 * 86400000000000 AS minus_2d,
               t + 1500 * 1000000 AS plus_1500ms, t + 250 * 1000 AS plus_250us, t + 7 AS plus_7ns,
               t + event_id * 1000000000 AS plus_id_s
        FROM {EV}""",
    "ns_units": f"""
        SELECT event_id, t // 1000000 AS epoch_ms, (t // 1000000) * 1000000 AS ms_ns,
               t // 1000000000 AS epoch_s, (t // 1000000000) * 1000000000 AS s_ns,
               event_id * 3600000000000 AS id_hours_ns
        FROM {EV}""",
    "ns_from_iso": f"""
        SELECT event_id, t AS time_ns,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || {_ISO_FRAC} || 'Z' AS iso,
               t AS parsed_ns, t AS parsed_trimmed_ns
        FROM {EV}""",
    "to_zone": f"""
        SELECT o_orderkey, {O_T} AS time_ns,
               epoch_us(timezone('Asia/Shanghai', timezone('UTC', o_orderdate))) * 1000 AS shanghai_ns,
               epoch_us(timezone('America/New_York', timezone('UTC', o_orderdate))) * 1000
                   AS new_york_ns,
               epoch_us(timezone('Europe/Paris', timezone('UTC', o_orderdate))) * 1000 AS paris_ns
        FROM orders""",
    "upsert_latest": " UNION ALL ".join(
        f"SELECT {LI_KEY} AS series_key, '{f}' AS field, {LI_T} AS time_ns, {f} AS value_double "
        f"FROM {_LI_WINNER}" for f in C.LINEITEM_FIELDS),
    "wide_points": f"""
        SELECT {LI_KEY} AS series_key, {LI_T} AS time_ns,
               {", ".join(C.LINEITEM_FIELDS)}
        FROM {_LI_WINNER}""",
}

ORACLE_SQL["flagship"] = f"""
        SELECT k AS series_key, 'value' AS field, count(*) AS n_records,
               min(t) AS first_ns, max(t) AS last_ns
        FROM {EV} WHERE t >= {A} AND t < {B} GROUP BY k"""

ORACLE_SQL["store_roundtrip"] = f"""
        SELECT k AS series_key, 'value' AS field, value AS value_double, t AS time_ns FROM {EV}"""
ORACLE_SQL["wide_variant"] = f"""
    SELECT *, 'OBJECT<' || concat_ws(', ', CASE WHEN event_id IS NOT NULL THEN 'event_id: BIGINT' END,
           CASE WHEN props IS NOT NULL THEN 'props: STRING' END, CASE WHEN value IS NOT NULL THEN 'value: DOUBLE' END) || '>' AS types
    FROM (SELECT {EV_KEY} AS series_key, {EV_T} AS time_ns, max(value) AS value, max(event_id) AS event_id, max(props) AS props
          FROM events WHERE value IS NOT NULL OR event_id IS NOT NULL OR props IS NOT NULL GROUP BY 1, 2)"""
ORACLE_SQL["store_series_scan"] = f"""
    SELECT k AS series_key, 'value' AS field, value AS value_double, t AS time_ns FROM {EV}
    WHERE k = (SELECT min(k) FROM {EV})"""
ORACLE_SQL["store_series_estimate"] = f"""
    SELECT 'all' AS part, 'events' AS measurement, count(DISTINCT k) AS n_exact, true AS within_bounds FROM {EV}
    UNION ALL
    SELECT 'range', 'events', count(DISTINCT k), true FROM {EV} WHERE t >= {A} AND t < {B}"""
ORACLE_SQL["store_range_scan"] = ORACLE_SQL["range_scan"]
ORACLE_SQL["stream_read_drain"] = ORACLE_SQL["encode_compat"]
ORACLE_SQL["format_range_scan"] = f"""
    SELECT k AS series_key, 'value' AS field, value AS value_double, t AS time_ns FROM {EV}
    WHERE t >= {A} AND t < {B} AND k LIKE 'events,event_type=click,%' AND value > 10"""
ORACLE_SQL["stream_upsert"] = ORACLE_SQL["upsert_long"]
# Gaps and islands; closed: a day after its last point, two days before the newest.
ORACLE_SQL["stream_sessions"] = f"""
    WITH g AS (SELECT k, t, CASE WHEN t - lag(t) OVER (PARTITION BY k ORDER BY t) <= 86400000000000 THEN 0 ELSE 1 END AS new
               FROM {EV}),
    s AS (SELECT k, t, sum(new) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING) AS nth FROM g)
    SELECT k AS series_key, min(t) AS first_ns, max(t) AS last_ns, count(*) AS n_records FROM s GROUP BY k, nth
    HAVING max(t) + 3 * 86400000000000 <= (SELECT max(t) FROM {EV})"""
ORACLE_SQL["stream_late_read"] = ORACLE_SQL["store_roundtrip"]
ORACLE_SQL["stream_format_write"] = ORACLE_SQL["store_roundtrip"]
ORACLE_SQL["quoted_records"] = ORACLE_SQL["stream_quoted_drain"] = """
SELECT 'documents' || coalesce(',lang=' || lang, '') || coalesce(',source=' || source, '') AS series_key,
  CAST(doc_id AS BIGINT) AS time_ns, length(text) AS n_chars, md5(text) AS text_md5
FROM documents WHERE text IS NOT NULL"""
ORACLE_SQL["stream_write_drain"] = ORACLE_SQL["store_roundtrip"]
ORACLE_SQL["decode_no_time"] = ORACLE_SQL["store_roundtrip"]
ORACLE_SQL["stream_arrival_drain"] = ORACLE_SQL["store_roundtrip"]
# The compat cursor stops at lo + ceil((hi - lo) / delta) * delta; every record
# below that is read once.
ORACLE_SQL["stream_compat_drain"] = f"""
        WITH b AS (SELECT min(t) AS lo, max(t) AS hi FROM {EV})
        SELECT k || ' value=' || CAST(value AS VARCHAR) || ' ' || CAST(t AS VARCHAR) AS value
        FROM {EV}, b
        WHERE t < lo + ((hi - lo + {C.COMPAT_DELTA_MS * 1_000_000 - 1}) // {C.COMPAT_DELTA_MS * 1_000_000})
                       * {C.COMPAT_DELTA_MS * 1_000_000}"""
