"""The named queries as SQL over the test tables, for cross-checking."""

from __future__ import annotations

from gaugeloom.plans.queries import PAGE, POINTS

# Fixed values, written out so that a wrong one in the engine shows.
HARD_UPPER_LIMIT = 62_100.0
HISTOGRAM_BINS = 256
CHI_SQUARED_95 = 3.841458820694124
CONSTANT, FIRST, SECOND, THIRD = -2.86154, -2.8903, -4.234, -40.040
MESSAGES = {
    "empty": "长度是0，不进一步分析",
    "zero_variance": "方差是0，不进一步分析",
    "white_noise": "可能是白噪声，不进一步分析",
    "signal": "非白噪声且方差非零",
    "test_failed": "白噪声判定失败",
}

# --- shared steps: each names one common table expression --------------------

EVENT_COLUMNS = """
    CAST(user_id AS VARCHAR) AS sn,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
    CAST(user_id % 4 AS INTEGER) AS slave_id,
    CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'],
                       event_type) - 1 AS INTEGER) AS type_id,
    event_id AS seq
"""
READINGS = f"""
readings AS (
  SELECT {EVENT_COLUMNS},
    substr(props, 1, length(props) - 1) || ', "value": ' || CAST(value AS VARCHAR)
      || ', "label": "zone: ' || event_type || '"}}' AS data
  FROM events)"""
LEGACY_READINGS = f"""
legacy_readings AS (
  SELECT {EVENT_COLUMNS},
    '{{u''k'':u''' || json_extract_string(props, '$.k') || ''',u''value'':u'''
      || CAST(value AS VARCHAR) || ''',u''label'':u''' || event_type
      || CASE WHEN event_type = 'purchase'
              THEN ''',u''paid'':u''' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
              ELSE '' END
      || '''}}' AS data
  FROM events)"""
FEATURES = (
    READINGS
    + """,
features AS (
  SELECT sn, date, seq, CAST(f.pos AS INTEGER) AS pos, f.feature,
    json_extract_string(data, '$.' || f.feature) AS value, slave_id, type_id
  FROM readings
  CROSS JOIN (VALUES (0, 'k'), (1, 'value'), (2, 'label')) AS f(pos, feature))"""
)
# Sides of each legacy part are split on the colon and cut out of their quotes.
LEGACY_FEATURES = (
    LEGACY_READINGS
    + r""",
legacy_parts AS (
  SELECT sn, date, seq, slave_id, type_id,
    string_split(replace(substr(data, 2, length(data) - 2), ' ', ''), ',') AS parts
  FROM legacy_readings),
legacy_places AS (
  SELECT sn, date, seq, slave_id, type_id, parts,
    unnest(range(len(parts))) AS pos
  FROM legacy_parts
  WHERE regexp_full_match(parts[1], 'u''[\w\W]*'':u''[\w\W]*''')),
legacy_features AS (
  SELECT sn, date, seq, CAST(pos AS INTEGER) AS pos,
    substr(string_split(parts[pos + 1], ':')[1], 3,
           length(string_split(parts[pos + 1], ':')[1]) - 3) AS feature,
    substr(string_split(parts[pos + 1], ':')[2], 3,
           length(string_split(parts[pos + 1], ':')[2]) - 3) AS value,
    slave_id, type_id
  FROM legacy_places)"""
)
NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\s*$"
SERIES = (
    FEATURES
    + f""",
series AS (
  SELECT sn, feature, date, seq, TRY_CAST(value AS DOUBLE) AS value
  FROM features
  WHERE regexp_matches(value, '{NUMBER}'))"""
)
ORDER_SERIES = """
series AS (
  SELECT CAST(o_custkey AS VARCHAR) AS sn, 'totalprice' AS feature,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date, o_orderkey AS seq,
    o_totalprice AS value
  FROM orders)"""
LINEITEM_SERIES = """
series AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS sn, f.feature,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date,
    (l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
     l_tax, l_returnflag, l_linestatus) AS seq,
    CASE f.feature WHEN 'quantity' THEN l_quantity ELSE l_extendedprice END AS value
  FROM lineitem CROSS JOIN (VALUES ('quantity'), ('price')) AS f(feature))"""
QUARTILES = """,
ranked AS (
  SELECT sn, feature, value,
    row_number() OVER (PARTITION BY sn, feature ORDER BY value) - 1 AS rank,
    count(*) OVER (PARTITION BY sn, feature) AS n
  FROM series),
quartiles AS (
  SELECT sn, feature, n,
    (max(value) FILTER (rank = least(floor(n * 0.25), n - 1))
     + max(value) FILTER (rank = least(ceil(n * 0.25), n - 1))) / 2 AS q25,
    (max(value) FILTER (rank = least(floor(n * 0.5), n - 1))
     + max(value) FILTER (rank = least(ceil(n * 0.5), n - 1))) / 2 AS q50,
    (max(value) FILTER (rank = least(floor(n * 0.75), n - 1))
     + max(value) FILTER (rank = least(ceil(n * 0.75), n - 1))) / 2 AS q75
  FROM ranked GROUP BY sn, feature, n),
bounds AS (
  SELECT *, q75 - q25 AS iqr, q25 - 1.5 * (q75 - q25) AS lower_bound,
    q75 + 1.5 * (q75 - q25) AS upper_bound
  FROM quartiles)"""
CLEANED = (
    QUARTILES
    + f""",
cleaned AS (
  SELECT s.sn, s.feature, s.date, s.seq, s.value
  FROM series s JOIN bounds b ON s.sn = b.sn AND s.feature = b.feature
  WHERE s.value BETWEEN lower_bound AND upper_bound
    AND s.value <= {HARD_UPPER_LIMIT})"""
)


def _first_rows(source: str) -> str:
    return f""",
timed AS (
  SELECT sn, feature, epoch(CAST(date AS TIMESTAMP)) AS time, value AS data
  FROM {source}
  QUALIFY row_number() OVER (
    PARTITION BY sn, feature, date ORDER BY seq) = 1)"""


def _zipped_rows(source: str) -> str:
    return f""",
firsts AS (
  SELECT sn, feature, epoch(CAST(date AS TIMESTAMP)) AS time, min(seq) AS first_seq,
    arg_min(value, seq) AS data
  FROM {source} GROUP BY ALL),
places AS (
  SELECT *, row_number() OVER (PARTITION BY sn, feature ORDER BY time) AS by_time,
    row_number() OVER (PARTITION BY sn, feature ORDER BY first_seq, data, time) AS by_seq
  FROM firsts),
timed AS (
  SELECT t.sn, t.feature, t.time, v.data
  FROM places t JOIN places v
    ON t.sn = v.sn AND t.feature = v.feature AND t.by_time = v.by_seq)"""


def _grid(source: str, rows=_first_rows) -> str:
    return (
        rows(source)
        + f""",
spans AS (
  SELECT sn, feature, min(time) AS start, max(time) AS stop,
    (max(time) - min(time)) / {POINTS - 1}.0 AS step
  FROM timed GROUP BY sn, feature HAVING max(time) > min(time)),
segments AS (
  SELECT sn, feature, time AS t0, data AS v0,
    lead(time) OVER w AS t1, lead(data) OVER w AS v1
  FROM timed WINDOW w AS (PARTITION BY sn, feature ORDER BY time)),
segment_places AS (
  SELECT g.sn, g.feature, t0, v0, t1, v1, start, stop, step,
    unnest(generate_series(
      CAST(ceil((t0 - start) / step) AS INTEGER),
      CASE WHEN t1 = stop THEN {POINTS - 1}
           ELSE CAST(ceil((t1 - start) / step) AS INTEGER) - 1 END)) AS idx
  FROM segments g JOIN spans s ON g.sn = s.sn AND g.feature = s.feature
  WHERE t1 IS NOT NULL),
placed AS (
  SELECT *, CASE WHEN idx = {POINTS - 1} THEN stop
                 ELSE start + idx * step END AS time FROM segment_places),
grid AS (
  SELECT sn, feature, CAST(idx AS INTEGER) AS idx, time,
    v0 + (v1 - v0) / (t1 - t0) * (time - t0) AS data
  FROM placed)"""
    )


def _statistic(source: str) -> str:
    return f""",
centred AS (
  SELECT sn, feature, date, seq, value,
    value - avg(value) OVER (PARTITION BY sn, feature) AS x
  FROM {source}),
lagged AS (
  SELECT *, lag(x) OVER (PARTITION BY sn, feature ORDER BY date, seq) AS before
  FROM centred),
correlated AS (
  SELECT sn, feature, count(*) AS n, min(value) = max(value) AS constant,
    CASE WHEN min(value) = max(value) THEN NULL
         ELSE sum(x * before) / nullif(sum(x * x), 0) END AS r1
  FROM lagged GROUP BY sn, feature),
statistic AS (
  SELECT *, n * (n + 2) * r1 * r1 / nullif(n - 1, 0) AS q FROM correlated)"""


VERDICT_KIND = f"""
CASE WHEN n IS NULL THEN 'empty'
     WHEN constant AND n >= 2 THEN 'zero_variance'
     WHEN q IS NULL THEN 'test_failed'
     WHEN q < {CHI_SQUARED_95!r} THEN 'white_noise'
     ELSE 'signal' END"""
VERDICTS = (
    _statistic("cleaned")
    + f""",
verdicts AS (SELECT *, {VERDICT_KIND} AS kind FROM statistic)"""
)
MESSAGE = (
    "CASE kind "
    + " ".join(f"WHEN '{kind}' THEN '{text}'" for kind, text in MESSAGES.items())
    + " END"
)
EVENTS_CLEANED = f"WITH {SERIES}{CLEANED}"
EVENTS_GRID = f"{EVENTS_CLEANED}{_grid('cleaned')}"
ORDER_NUMBERS = """
  SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS row_number
  FROM orders"""


def _trend(source: str, time: str, value: str) -> str:
    return f"""
SELECT sn, feature, sn || '_' || feature || '.csv' AS file,
  round(coalesce(regr_slope({value}, {time}), 0), 10) AS coef,
  round(coalesce(regr_intercept({value}, {time}), avg({value})), 2) AS intercept
FROM {source} GROUP BY sn, feature"""


def _quantile_columns() -> str:
    return """
SELECT sn, feature, n, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75
FROM quartiles"""


def _statistic_columns() -> str:
    return """
SELECT sn, feature, n, round(r1, 8) AS r1, round(q, 6) AS q FROM statistic"""


def _summary(source: str, value: str) -> str:
    return f"""
SELECT sn, feature, sn || '_' || feature || '.csv' AS file,
  round(var_samp({value}), 6) AS var, round(avg({value}), 9) AS mean
FROM {source} GROUP BY sn, feature"""


def _key_difference(left: str, left_key: str, right: str, right_key: str, kind: str) -> str:
    return f"""
SELECT DISTINCT CAST({left_key} AS VARCHAR) AS path, '{kind}' AS kind FROM {left}
WHERE {left_key} NOT IN (SELECT {right_key} FROM {right})"""


MEASURED = """
measured AS (
  SELECT event_id, CAST(value AS VARCHAR) AS value,
    json_extract_string(props, '$.k') AS k FROM events),
remeasured AS (
  SELECT event_id, CAST(round(value, 1) AS VARCHAR) AS value,
    CASE WHEN length(json_extract_string(props, '$.k')) < 2
         THEN '0' || json_extract_string(props, '$.k')
         ELSE substr(json_extract_string(props, '$.k'), 1, 2) END AS k FROM events)"""
INTEGER = "^[+-]?[0-9]+$"


def _same(left: str, right: str, relative: float) -> str:
    """Cell rule for finite decimal text."""
    a, b = f"CAST({left} AS DOUBLE)", f"CAST({right} AS DOUBLE)"
    return f"""
({left} = {right} OR (
  NOT (regexp_matches({left}, '{INTEGER}') AND regexp_matches({right}, '{INTEGER}'))
  AND abs({a} - {b}) <= greatest(
    greatest(abs({a}), abs({b})) * {relative!r}, 1e-12)))"""


CELLS = f"""WITH {MEASURED},
cells AS (
  SELECT m.event_id, 1 AS column_no, m.value AS expected, r.value AS actual
  FROM measured m JOIN remeasured r ON m.event_id = r.event_id
  UNION ALL
  SELECT m.event_id, 2, m.k, r.k
  FROM measured m JOIN remeasured r ON m.event_id = r.event_id),
unequal AS (
  SELECT * FROM cells WHERE NOT {_same('expected', 'actual', 1e-3)})"""

FORBIDDEN = r'[<>:"/\\|?*\x00-\x1f]'
RESERVED = (
    "('.', '..', 'con', 'prn', 'aux', 'nul', "
    + ", ".join(f"'{stem}{i}'" for stem in ("com", "lpt") for i in range(1, 10))
    + ")"
)

FLOAT_SERIES = f"""
columns_seen AS (
  SELECT sn, feature, count(*) AS present,
    count(*) FILTER (regexp_matches(value, '{NUMBER}')) AS numeric_cells,
    count(*) FILTER (regexp_matches(value, '^[+-]?[0-9]+$')) AS integer_cells
  FROM legacy_features GROUP BY sn, feature),
device_rows AS (SELECT sn, count(*) AS rows FROM legacy_readings GROUP BY sn),
float_series AS (
  SELECT c.sn, c.feature FROM columns_seen c JOIN device_rows d ON c.sn = d.sn
  WHERE numeric_cells = present AND (integer_cells < present OR present < rows))"""

HISTOGRAM = f"""
values_seen AS (SELECT sn, feature, round(data, 6) AS v FROM grid),
edges AS (
  SELECT sn, feature,
    CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS low,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS high
  FROM values_seen GROUP BY sn, feature),
guessed AS (
  SELECT v.sn, v.feature, v, low, high,
    least(CAST(floor((v - low) / (high - low) * {HISTOGRAM_BINS}) AS BIGINT),
          {HISTOGRAM_BINS - 1}) AS guess
  FROM values_seen v JOIN edges e ON v.sn = e.sn AND v.feature = e.feature),
binned AS (
  SELECT sn, feature,
    CASE WHEN v < low + guess * ((high - low) / {HISTOGRAM_BINS}) THEN guess - 1
         WHEN guess < {HISTOGRAM_BINS - 1}
              AND v >= low + (guess + 1) * ((high - low) / {HISTOGRAM_BINS})
         THEN guess + 1 ELSE guess END AS bin
  FROM guessed),
counted AS (SELECT sn, feature, bin, count(*) AS rows FROM binned GROUP BY ALL),
every_bin AS (
  SELECT sn, feature, low, high, CAST(unnest(range({HISTOGRAM_BINS})) AS INTEGER) AS bin
  FROM edges)"""

ORACLES: dict[str, str] = {
    "series_profile": f"{EVENTS_CLEANED} {_summary('cleaned', 'value')}",
    "read_pages": f"""WITH {READINGS}
SELECT CAST(floor(seq_no / {PAGE}) AS BIGINT) + 1 AS page_no, sn, date, data, slave_id, type_id
FROM (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS seq_no FROM readings)""",
    "read_page_rows": f"""WITH {READINGS}
SELECT CAST(floor(seq_no / {PAGE}) AS BIGINT) + 1 AS page_no, sn, date, data, slave_id, type_id
FROM (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS seq_no FROM readings)""",
    "offset_pages": f"""
SELECT CAST(floor((row_number - 1) / {PAGE}) AS BIGINT) AS page_no, row_number,
  o_custkey, o_orderkey
FROM ({ORDER_NUMBERS}) WHERE row_number > {PAGE}""",
    "keyset_pages": f"""
SELECT CAST(floor((row_number - 1) / {PAGE}) AS BIGINT) + 1 AS page_no, row_number,
  o_custkey, o_orderkey
FROM ({ORDER_NUMBERS})""",
    "keyset_page": f"""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE (o_custkey, o_orderkey) > (50, 700)
ORDER BY o_custkey, o_orderkey LIMIT {PAGE}""",
    "page_numbering": f"""
SELECT row_number, CAST(floor((row_number - 1) / {PAGE}) AS BIGINT) + 1 AS page_no,
  l_orderkey, l_linenumber, l_partkey
FROM (
  SELECT *, row_number() OVER (
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  ) AS row_number FROM lineitem)""",
    "last_key": f"""
SELECT page_no, max(key).o_custkey AS o_custkey, max(key).o_orderkey AS o_orderkey
FROM (
  SELECT CAST(floor((row_number - 1) / {PAGE}) AS BIGINT) + 1 AS page_no,
    struct_pack(o_custkey := o_custkey, o_orderkey := o_orderkey) AS key
  FROM ({ORDER_NUMBERS}))
GROUP BY page_no""",
    "page_summary": f"""
SELECT mode, CAST(floor(row_count / {PAGE}) AS BIGINT) + 1 AS page_count, row_count
FROM (
  SELECT 'legacy' AS mode, greatest(count(*) - {PAGE}, 0) AS row_count FROM orders
  UNION ALL SELECT 'corrected', count(*) FROM orders)""",
    "write_series": f"""WITH {SERIES}
SELECT sn, feature, count(*) AS rows, CAST(1 AS BIGINT) AS folders,
  round(sum(value), 4) AS total
FROM series GROUP BY sn, feature""",
    "read_series": f"""WITH {SERIES}
SELECT * FROM series
WHERE (sn = '1' AND feature = 'k') OR (sn IN ('1', '7') AND feature = 'value')""",
    "write_once": f"""WITH {READINGS}
SELECT sn, date, data, slave_id, type_id, seq FROM readings""",
    "valid_series_name": f"""
SELECT valid, count(*) AS names FROM (
  SELECT length(name) BETWEEN 1 AND 128
    AND NOT regexp_matches(name, '{FORBIDDEN}')
    AND right(name, 1) NOT IN ('.', ' ')
    AND lower(name) NOT IN {RESERVED} AS valid
  FROM (SELECT url AS name FROM pages UNION ALL SELECT c_name FROM customer
        UNION ALL SELECT text FROM documents))
GROUP BY valid""",
    "select_raw": f"WITH {READINGS} SELECT sn, date, data, slave_id, type_id FROM readings",
    "group_by_device": f"""WITH {READINGS}
SELECT sn, 2 * count(*) AS rows, min(date) AS first_date, max(date) AS last_date
FROM readings GROUP BY sn""",
    "distinct_devices": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS sn FROM events",
    "parse_payload_corrected": f"""WITH {FEATURES}
SELECT sn, seq, pos, feature, value FROM features""",
    "parse_payload_literal": f"""WITH {LEGACY_FEATURES}
SELECT sn, seq, pos, feature, value FROM legacy_features""",
    "parse_payload_legacy": f"""WITH {LEGACY_FEATURES}
SELECT sn, seq, pos, feature, value FROM legacy_features""",
    "parse_payload_legacy_json": f"""WITH {READINGS}
SELECT sn, seq, CAST(CASE WHEN regexp_full_match(
    string_split(replace(substr(data, 2, length(data) - 2), ' ', ''), ',')[1],
    '"[\\w\\W]*":"[\\w\\W]*"') THEN 3 ELSE 0 END AS INTEGER) AS entries
FROM readings""",
    "parse_feature_rows": f"""WITH {FEATURES}
SELECT sn, date, seq, pos, feature, value, slave_id, type_id FROM features""",
    "bad_payloads": """
SELECT conv_id, turn FROM conversations
WHERE CASE WHEN json_valid(text) THEN json_type(text) <> 'OBJECT' ELSE true END""",
    "bad_readings": f"""WITH {READINGS},{LEGACY_READINGS},
both_kinds AS (
  SELECT sn, data, seq, seq AS own FROM readings
  UNION ALL SELECT sn, data, seq, -seq - 1 FROM legacy_readings)
SELECT own AS seq, b.sn, substr(data, 1, length(data) - 1) AS data
FROM both_kinds b JOIN events e ON own = e.event_id WHERE e.value > 25""",
    "device_positions": """
SELECT row_number() OVER (ORDER BY sn) AS position, sn
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS sn FROM events)""",
    "feature_order": f"""WITH {LEGACY_FEATURES},
seen AS (
  SELECT sn, feature, min((seq, pos)) AS place
  FROM legacy_features GROUP BY sn, feature)
SELECT sn, feature,
  CAST(row_number() OVER (PARTITION BY sn ORDER BY place) AS INTEGER) AS feature_position
FROM seen""",
    "pivot_features": f"""WITH {LEGACY_FEATURES}
SELECT sn, date, seq,
  max(value) FILTER (feature = 'k') AS k, max(value) FILTER (feature = 'value') AS value,
  max(value) FILTER (feature = 'label') AS label,
  max(value) FILTER (feature = 'paid') AS paid, slave_id, type_id
FROM legacy_features GROUP BY sn, date, seq, slave_id, type_id""",
    "merge_and_sort": f"""WITH {FEATURES},
chunks AS (
  SELECT sn, date, seq, 1 AS chunk, value AS k, NULL AS value
  FROM features WHERE feature = 'k'
  UNION ALL
  SELECT sn, date, seq, 2, NULL, value FROM features WHERE feature = 'value')
SELECT sn, date,
  row_number() OVER (PARTITION BY sn ORDER BY date, chunk, seq) AS position, k, value
FROM chunks""",
    "merge_and_sort_all": f"""WITH {FEATURES}
SELECT sn, date,
  row_number() OVER (PARTITION BY sn ORDER BY date, feature, seq) AS position, feature, value
FROM features""",
    "drop_nulls": f"""WITH {FEATURES}
SELECT sn, feature, date, seq, TRY_CAST(value AS DOUBLE) AS value FROM features
WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL""",
    "split_numeric_corrected": f"WITH {SERIES} SELECT * FROM series",
    "split_numeric_legacy": f"""WITH {LEGACY_FEATURES}, {FLOAT_SERIES}
SELECT l.sn, l.feature, l.date, l.seq, CAST(l.value AS DOUBLE) AS value
FROM legacy_features l JOIN float_series f ON l.sn = f.sn AND l.feature = f.feature""",
    "split_numeric_booleans": f"""WITH {READINGS},
cells AS (
  SELECT r.sn, r.date, r.seq, f.feature,
    CASE f.feature WHEN 'state' THEN CASE WHEN event_type <> 'error' THEN value END
                   END AS number,
    CASE WHEN f.feature = 'state' THEN CASE WHEN event_type = 'error' THEN 1.0 END
         WHEN value > 25 THEN 1.0 ELSE 0.0 END AS flag
  FROM readings r JOIN events e ON r.seq = e.event_id
  CROSS JOIN (VALUES ('flag'), ('paid'), ('state')) AS f(feature)
  WHERE f.feature <> 'paid' OR event_type = 'purchase'),
marked AS (
  SELECT *, count(number) OVER (PARTITION BY sn, feature) AS numbers FROM cells)
SELECT sn, feature, date, seq,
  CAST(CASE WHEN numbers = 0 THEN flag ELSE number END AS DOUBLE) AS value
FROM marked WHERE numbers = 0 OR number IS NOT NULL""",
    "legacy_float_series": f"""WITH {LEGACY_FEATURES}, {FLOAT_SERIES}
SELECT sn, feature FROM float_series""",
    "legacy_quantile": f"WITH {SERIES}{QUARTILES} {_quantile_columns()}",
    "legacy_quantile_lineitem": f"WITH {LINEITEM_SERIES}{QUARTILES} {_quantile_columns()}",
    "outlier_bounds": f"""WITH {SERIES}{QUARTILES}
SELECT b.sn, b.feature, n, round(q25, 6) AS q25, round(q75, 6) AS q75,
  round(iqr, 6) AS iqr, round(lower_bound, 6) AS lower, round(upper_bound, 6) AS upper,
  count(*) FILTER (NOT (s.value BETWEEN lower_bound AND upper_bound
                        AND s.value <= {HARD_UPPER_LIMIT})) AS n_dropped
FROM bounds b JOIN series s ON s.sn = b.sn AND s.feature = b.feature
GROUP BY ALL""",
    "remove_outliers": f"{EVENTS_CLEANED} SELECT * FROM cleaned",
    "remove_outliers_orders": f"WITH {ORDER_SERIES}{CLEANED} SELECT * FROM cleaned",
    "remove_outliers_lineitem": f"""WITH {LINEITEM_SERIES}{CLEANED}
SELECT sn, feature, count(*) AS rows, round(sum(value), 4) AS total
FROM cleaned GROUP BY sn, feature""",
    "finite_check": f"""WITH {LINEITEM_SERIES}
SELECT sn, feature, value <> 1 AS finite, count(*) AS rows
FROM series GROUP BY ALL""",
    "epoch_seconds": f"""{EVENTS_CLEANED}
SELECT sn, feature, epoch(CAST(date AS TIMESTAMP)) AS time, value AS data
FROM cleaned""",
    "dedupe_timestamps": f"""WITH {LINEITEM_SERIES}{_first_rows('series')}
SELECT sn, feature, time, data FROM timed""",
    "linspace_grid": f"""{EVENTS_GRID}
SELECT sn, feature, CAST(i AS INTEGER) AS idx,
  round(CASE WHEN i = {POINTS - 1} THEN stop ELSE start + i * step END, 3) AS time
FROM (SELECT *, unnest(range({POINTS})) AS i FROM spans)""",
    "interpolate_series": f"""{EVENTS_GRID}
SELECT sn, feature, idx, round(time, 3) AS time, round(data, 6) AS data FROM grid""",
    "interpolate_lineitem": f"""WITH {LINEITEM_SERIES}{_grid('series')}
SELECT sn, feature, idx, round(time, 3) AS time, round(data, 6) AS data FROM grid""",
    "interpolate_legacy": f"""{EVENTS_CLEANED}{_grid('cleaned', _zipped_rows)}
SELECT sn, feature, CAST(idx // 1000 AS BIGINT) AS block, count(*) AS points,
  round(avg(time), 2) AS time, round(avg(data), 6) AS data,
  round(min(data), 6) AS low, round(max(data), 6) AS high
FROM grid GROUP BY ALL""",
    "zip_in_input_order": f"""WITH {LINEITEM_SERIES}{_zipped_rows('series')}
SELECT sn, feature, time, data FROM timed""",
    "statistics_order": f"""{EVENTS_CLEANED}
SELECT row_number() OVER (ORDER BY lower(file), file) AS position, file, mean
FROM ({_summary('cleaned', 'value')})""",
    "summary_statistics": f"{EVENTS_GRID} {_summary('grid', 'data')}",
    "linear_trend": f"""{EVENTS_CLEANED}
{_trend('cleaned', 'epoch(CAST(date AS TIMESTAMP))', 'value')}""",
    "linear_trend_from_timestamps": f"{EVENTS_GRID} {_trend('grid', 'time', 'data')}",
    "histogram": f"""{EVENTS_GRID}, {HISTOGRAM}
SELECT b.sn, b.feature, b.bin,
  low + b.bin * ((high - low) / {HISTOGRAM_BINS}) AS bin_start,
  CASE WHEN b.bin = {HISTOGRAM_BINS - 1} THEN high
       ELSE low + (b.bin + 1) * ((high - low) / {HISTOGRAM_BINS}) END AS bin_end,
  coalesce(c.rows, 0) AS count
FROM every_bin b LEFT JOIN counted c
  ON b.sn = c.sn AND b.feature = c.feature AND b.bin = c.bin""",
    "series_plot_data": f"""{EVENTS_CLEANED},
timed_rows AS (
  SELECT sn, feature, seq, CAST(epoch(CAST(date AS TIMESTAMP)) AS BIGINT) AS time, value
  FROM cleaned),
ends AS (
  SELECT sn, feature, min(time) AS start, max(time) AS stop
  FROM timed_rows GROUP BY sn, feature),
bucketed AS (
  SELECT r.*, CASE WHEN stop = start THEN 0 ELSE
    least(CAST(floor(CAST(time - start AS DOUBLE) / (stop - start) * 20) AS BIGINT), 19)
    END AS bucket
  FROM timed_rows r JOIN ends e ON r.sn = e.sn AND r.feature = e.feature)
SELECT sn, feature, bucket, min(time) AS first_time, max(time) AS last_time,
  arg_min(value, (time, seq)) AS first_value, arg_max(value, (time, seq)) AS last_value,
  min(value) AS low, max(value) AS high, count(*) AS rows
FROM bucketed GROUP BY sn, feature, bucket""",
    "series_points": f"""WITH {ORDER_SERIES}
SELECT sn, feature, date, seq, value AS measurement FROM series""",
    "ljung_box_q": f"{EVENTS_CLEANED}{_statistic('cleaned')} {_statistic_columns()}",
    "ljung_box_q_lineitem": (
        f"WITH {LINEITEM_SERIES}{_statistic('series')} {_statistic_columns()}"
    ),
    # The tail 1 - 2/sqrt(pi) * integral of exp(-t^2) by Simpson's rule.
    "ljung_box": f"""{EVENTS_CLEANED}{_statistic('cleaned')},
nodes AS (SELECT unnest(range(2001)) AS i),
integrals AS (
  SELECT sn, feature, n, q,
    sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
        * exp(-(q / 2) * (i / 2000.0) * (i / 2000.0))) * sqrt(q / 2) / 6000.0 AS area
  FROM statistic CROSS JOIN nodes GROUP BY sn, feature, n, q)
SELECT sn, feature, n, round(q, 6) AS q,
  round(abs(1 - 2 / sqrt(pi()) * area), 8) AS p_value
FROM integrals""",
    "classify_series": f"""{EVENTS_CLEANED}{VERDICTS}
SELECT sn, feature, n, kind, {MESSAGE} AS message,
  kind IN ('signal', 'test_failed') AS should_continue
FROM verdicts""",
    "classify_every_series": f"""{EVENTS_CLEANED}{VERDICTS},
listed AS (SELECT DISTINCT sn, feature FROM features)
SELECT l.sn, l.feature, coalesce(kind, 'empty') AS kind,
  coalesce(kind IN ('signal', 'test_failed'), false) AS should_continue
FROM listed l LEFT JOIN verdicts v ON l.sn = v.sn AND l.feature = v.feature""",
    "keep_signals": f"""{EVENTS_CLEANED}{VERDICTS}
SELECT c.sn, c.feature, c.date AS time, c.value AS data
FROM cleaned c JOIN verdicts v ON c.sn = v.sn AND c.feature = v.feature
WHERE kind IN ('signal', 'test_failed')""",
    "difference": f"""{EVENTS_GRID}
SELECT sn, feature, idx, round(change, 6) AS data
FROM (SELECT *, data - lag(data) OVER (
        PARTITION BY sn, feature ORDER BY idx) AS change FROM grid)
WHERE change IS NOT NULL""",
    "dickey_fuller": f"""{EVENTS_GRID},
steps AS (
  SELECT sn, feature, data - level AS step, level
  FROM (SELECT *, lag(data) OVER (PARTITION BY sn, feature ORDER BY idx) AS level
        FROM grid)
  WHERE level IS NOT NULL),
sums AS (
  SELECT sn, feature, count(*) AS n, regr_sxx(step, level) AS sxx,
    regr_sxy(step, level) AS sxy, regr_syy(step, level) AS syy
  FROM steps GROUP BY sn, feature),
tested AS (
  SELECT sn, feature, n,
    (sxy / nullif(sxx, 0))
      / sqrt((syy - sxy * sxy / nullif(sxx, 0)) / (n - 2) / nullif(sxx, 0)) AS statistic,
    {CONSTANT} + (1.0 / n) * ({FIRST} + (1.0 / n) * ({SECOND} + (1.0 / n) * {THIRD}))
      AS critical
  FROM sums)
SELECT sn, feature, n, round(statistic, 5) AS statistic,
  round(CAST(critical AS DOUBLE), 6) AS critical, statistic < critical AS stationary
FROM tested""",
    "arima_bic_walk": f"""{EVENTS_GRID},
sums AS (
  SELECT sn, feature, 0 AS d, count(*) AS n, var_pop(data) AS variance
  FROM grid GROUP BY sn, feature
  UNION ALL
  SELECT sn, feature, 1, count(change), avg(change * change)
  FROM (SELECT sn, feature, data - lag(data) OVER (
          PARTITION BY sn, feature ORDER BY idx) AS change FROM grid)
  GROUP BY sn, feature)
SELECT sn, feature, 0 AS p, d, 0 AS q,
  round(n * (ln(2 * pi() * variance) + 1) + (CASE d WHEN 0 THEN 2 ELSE 1 END) * ln(n), 4)
    AS bic
FROM sums""",
    "unit_root_one_lag": f"""{EVENTS_CLEANED},
levels AS (
  SELECT sn, feature, value, lag(value) OVER series AS level, lag(value, 2) OVER series AS older
  FROM cleaned WINDOW series AS (PARTITION BY sn, feature ORDER BY date, seq)),
steps AS (
  SELECT sn, feature, value - level AS y, level AS x, level - older AS w FROM levels WHERE older IS NOT NULL),
sums AS (
  SELECT sn, feature, count(*) AS rows, regr_sxx(y, x) AS xx, regr_sxx(y, w) AS ww, regr_syy(y, x) AS yy,
    regr_sxy(y, x) AS xy, regr_sxy(y, w) AS wy, regr_sxy(x, w) AS xw
  FROM steps GROUP BY sn, feature),
swept AS (
  SELECT *, xx - xw * xw / ww AS a, xy - xw * wy / ww AS b, yy - wy * wy / ww AS c FROM sums
  WHERE rows > 3 AND ww > 0),
tested AS (
  SELECT sn, feature, rows, (b / a) / sqrt((c - b * b / a) / (rows - 3) / a) AS statistic,
    {CONSTANT} + (1.0 / rows) * ({FIRST} + (1.0 / rows) * ({SECOND} + (1.0 / rows) * {THIRD})) AS critical
  FROM swept),
listed AS (SELECT sn, feature, count(*) AS n FROM cleaned GROUP BY sn, feature)
SELECT l.sn, l.feature, l.n, t.rows, round(statistic, 5) AS statistic,
  round(CAST(critical AS DOUBLE), 6) AS critical, statistic < critical AS stationary
FROM listed l LEFT JOIN tested t ON l.sn = t.sn AND l.feature = t.feature""",
    "autoregression_bics": f"""{EVENTS_GRID},
moved AS (
  SELECT sn, feature, 0 AS d, idx, data - avg(data) OVER (PARTITION BY sn, feature) AS x FROM grid
  UNION ALL
  SELECT sn, feature, 1, idx, change FROM (
    SELECT *, data - lag(data) OVER (PARTITION BY sn, feature ORDER BY idx) AS change FROM grid)
  WHERE change IS NOT NULL),
products AS (
  SELECT sn, feature, d, count(*) AS n, sum(x * x) AS r0, sum(x * before) AS r1
  FROM (SELECT *, lag(x) OVER (PARTITION BY sn, feature, d ORDER BY idx) AS before FROM moved)
  GROUP BY sn, feature, d)
SELECT sn, feature, p, d, 0 AS q,
  round(n * (ln(2 * pi() * (r0 - p * r1 * r1 / r0) / n) + 1) + (p + 2 - d) * ln(n), 2) AS bic
FROM products, unnest([0, 1]) AS t(p)""",
    "lowest_bic": """
WITH candidates AS (
  SELECT CAST(user_id AS VARCHAR) AS sn, event_type AS feature,
    CAST(json_extract_string(props, '$.k') AS INTEGER) // 10 AS p,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS q, 1 AS d,
    CASE WHEN value >= 2 THEN floor(value) END AS bic
  FROM events),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY sn, feature ORDER BY bic NULLS LAST, p, q) AS place,
    count(*) OVER (PARTITION BY sn, feature) AS tested,
    count(*) FILTER (bic IS NULL) OVER (PARTITION BY sn, feature) AS failed
  FROM candidates)
SELECT sn, feature, bic, CASE WHEN bic IS NOT NULL THEN p END AS p,
  CASE WHEN bic IS NOT NULL THEN d END AS d, CASE WHEN bic IS NOT NULL THEN q END AS q,
  tested, failed
FROM ranked WHERE place = 1""",
    "missing_keys": _key_difference(
        "customer", "c_custkey", "supplier", "s_suppkey", "missing"
    ),
    "missing_labels": """
SELECT DISTINCT CAST(d.doc_id AS VARCHAR) AS path, 'missing' AS kind
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "unexpected_keys": _key_difference(
        "orders", "o_orderkey", "lineitem", "l_orderkey", "unexpected"
    ),
    "row_count_diff": """
SELECT '.' AS path, 'row_count' AS kind, CAST(e AS VARCHAR) AS expected,
  CAST(a AS VARCHAR) AS actual
FROM (SELECT (SELECT count(*) FROM orders) AS e, (SELECT count(*) FROM lineitem) AS a)
WHERE e <> a""",
    "cell_diff": f"""{CELLS}
SELECT CAST(event_id AS VARCHAR) AS path, column_no, 'value' AS kind, expected, actual
FROM unequal""",
    "positional_diff": f"""{CELLS},
numbered AS (
  SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_no FROM events)
SELECT row_no, column_no, expected, actual
FROM unequal u JOIN numbered n ON u.event_id = n.event_id""",
    "cells_match": f"""WITH {MEASURED}
SELECT m.event_id, {_same('m.value', 'r.value', 1e-2)} AS same
FROM measured m JOIN remeasured r ON m.event_id = r.event_id""",
    "content_hash_diff": """
SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS expected,
  sha256(lower(text)) AS actual
FROM documents WHERE text <> lower(text)""",
    "compare_tables": f"""{CELLS}
SELECT CAST(event_id AS VARCHAR) AS path, column_no, 'value' AS kind, expected, actual
FROM unequal""",
    "multiset_diff": f"""
WITH changed AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
    l_quantity + CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END AS l_quantity,
    unnest(range(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END)) AS copy
  FROM lineitem WHERE l_shipdate >= DATE '1994-01-01'),
counts AS (
  SELECT key, cells, sum(e) AS e, sum(a) AS a FROM (
    SELECT l_orderkey AS key, [CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR),
      l_returnflag] AS cells, 1 AS e, 0 AS a FROM lineitem
    UNION ALL
    SELECT l_orderkey, [CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR),
      l_returnflag], 0, 1 FROM changed)
  GROUP BY ALL),
totals AS (SELECT key, sum(e) AS e, sum(a) AS a FROM counts GROUP BY key),
open_rows AS (
  SELECT c.key, cells, c.e > c.a AS mine,
    unnest(range(CAST(abs(c.e - c.a) AS BIGINT))) AS copy
  FROM counts c JOIN totals t ON c.key = t.key WHERE t.e > 0 AND t.a > 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key, mine ORDER BY cells) AS n FROM open_rows),
paired AS (
  SELECT coalesce(x.key, y.key) AS key, x.cells AS expected, y.cells AS actual
  FROM (SELECT * FROM placed WHERE mine) x
  FULL JOIN (SELECT * FROM placed WHERE NOT mine) y ON x.key = y.key AND x.n = y.n),
cells AS (
  SELECT key, column_no, expected[column_no] AS expected, actual[column_no] AS actual
  FROM paired, unnest([1, 2, 3]) AS t(column_no)
  WHERE expected IS NOT NULL AND actual IS NOT NULL)
SELECT '.' AS path, CAST(NULL AS INTEGER) AS column_no, 'row_count' AS kind,
  CAST(sum(e) AS VARCHAR) AS expected, CAST(sum(a) AS VARCHAR) AS actual
FROM totals HAVING sum(e) <> sum(a)
UNION ALL
SELECT CAST(key AS VARCHAR), NULL, CASE WHEN a = 0 THEN 'missing' ELSE 'unexpected' END,
  NULL, NULL FROM totals WHERE e = 0 OR a = 0
UNION ALL
SELECT CAST(key AS VARCHAR), NULL,
  CASE WHEN actual IS NULL THEN 'missing_row' ELSE 'unexpected_row' END,
  '["' || array_to_string(expected, '","') || '"]',
  '["' || array_to_string(actual, '","') || '"]'
FROM paired WHERE expected IS NULL OR actual IS NULL
UNION ALL
SELECT CAST(key AS VARCHAR), column_no, 'value', expected, actual
FROM cells WHERE expected <> actual""",
    "compare_folders": f"""WITH {READINGS},
placed AS (
  SELECT *, row_number() OVER (ORDER BY seq) - 1 AS place FROM readings),
cells AS (
  SELECT *, 'SqlData' || CAST(place // {PAGE} + 1 AS VARCHAR) || '.csv' AS path, place % {PAGE} + 2 AS row_no
  FROM placed)
SELECT path, row_no, CAST(5 AS INTEGER) AS column_no, 'value' AS kind,
  CAST(slave_id AS VARCHAR) AS expected, CAST(slave_id + 1 AS VARCHAR) AS actual
FROM cells WHERE seq % 10 = 0
UNION ALL SELECT path, row_no, 3, 'value', date, '' FROM cells WHERE seq % 7 = 0""",
    "stage_counts": f"""{EVENTS_GRID}{VERDICTS},
kept AS (
  SELECT c.sn, c.feature FROM cleaned c
  JOIN verdicts v ON c.sn = v.sn AND c.feature = v.feature
  WHERE kind IN ('signal', 'test_failed')),
spread AS (SELECT DISTINCT sn, feature FROM grid)
SELECT 'DataProcess1' AS output, count(*) AS rows, count(DISTINCT sn) AS devices,
  CAST(NULL AS BIGINT) AS series FROM readings
UNION ALL SELECT 'DataProcess2', count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM features
UNION ALL SELECT 'DataProcess4', count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM series
UNION ALL SELECT 'DataProcess5', count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM cleaned
UNION ALL SELECT 'DataProcess9', count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM grid
UNION ALL SELECT 'DataProcess3', count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM features
UNION ALL SELECT unnest(['DataProcess6', 'DataProcess8']), count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM cleaned
UNION ALL SELECT 'DataProcess7', count(*), count(DISTINCT sn), count(*) FROM verdicts
UNION ALL SELECT 'DataProcess7Kept', count(*), count(DISTINCT sn),
  count(DISTINCT (sn, feature)) FROM kept
UNION ALL SELECT 'DataProcess11', {HISTOGRAM_BINS} * count(*), count(DISTINCT sn), count(*) FROM spread
UNION ALL SELECT unnest(['DataProcess10', 'DataProcess12', 'DataProcess13']), count(*), count(DISTINCT sn),
  count(*) FROM spread""",
    "stage_outputs": f"""{EVENTS_GRID}{VERDICTS}
SELECT g.sn, g.feature, g.sn || '_' || g.feature || '.csv' AS file, v.kind,
  round(var_samp(data), 6) AS var, round(avg(data), 9) AS mean,
  round(regr_slope(data, time), 10) AS coef
FROM grid g JOIN verdicts v ON g.sn = v.sn AND g.feature = v.feature
GROUP BY g.sn, g.feature, v.kind""",
}
