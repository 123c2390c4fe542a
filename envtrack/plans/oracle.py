"""DuckDB SQL for the correctness oracle.

The same rules as the Spark code, written independently as SQL over the pre-registered ``events``
view, so the driver can run each registered query in both engines and compare. Reading ids are
never compared across engines (the canonical double text differs); the dedupe here keys on the
identifying values themselves, which is the same partition of rows.
"""

from __future__ import annotations

# The rules' values, written out here once more: an error in the library's own copy must not pass.
MISSING = ["", "nan", "none", "null", "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan",
           "<na>", "n/a", "na"]
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?$"
FLOATS, BOOLS = ["co", "humidity", "lpg", "smoke", "temp"], ["light", "motion"]

WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"

# The raw-readings rule of FIXTURES.md section 3 ({STR} = VARCHAR, {US} = epoch_us(ts)), with a
# provenance marker for the appended copies.
RAW_SQL = """
r AS (
SELECT event_id,
 CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 97 = 1 THEN 'not-a-timestamp'
      WHEN event_id % 83 = 0 THEN substr(us,1,13) ELSE concat(substr(us,1,10),'.',substr(us,11,6)) END AS ts,
 CASE WHEN event_id % 97 = 2 THEN '' WHEN event_id % 97 = 3 THEN '   '
      ELSE concat('dev-', lpad(CAST(user_id AS VARCHAR),4,'0')) END AS device,
 CASE WHEN event_id % 89 = 0 THEN 'bad-value' ELSE concat('0.', lpad(CAST(c % 10000 AS VARCHAR),5,'0')) END AS co,
 CASE WHEN event_id % 89 = 3 THEN 'N/A' ELSE concat(k,'.0') END AS humidity,
 CASE WHEN event_id % 89 = 1 THEN 'maybe' WHEN event_type='view' THEN 'true' ELSE 'false' END AS light,
 CASE WHEN event_id % 89 = 6 THEN '1d' ELSE concat('0.', lpad(CAST((c*7) % 10000 AS VARCHAR),5,'0')) END AS lpg,
 CASE WHEN event_id % 89 = 4 THEN '1' WHEN event_type='click' THEN 'TRUE' ELSE 'FALSE' END AS motion,
 CASE WHEN event_id % 89 = 5 THEN 'true' ELSE concat('0.', lpad(CAST(c AS VARCHAR),5,'0')) END AS smoke,
 CASE WHEN event_id % 89 = 2 THEN '' ELSE concat(CAST(CAST(k AS INT) % 40 AS VARCHAR),'.',CAST(c % 10 AS VARCHAR)) END AS temp
FROM (SELECT event_id, user_id, event_type, CAST(epoch_us(ts) AS VARCHAR) AS us,
        CAST(round(value*100) AS BIGINT) AS c, regexp_extract(props,'[0-9]+',0) AS k FROM events) e
),
raw AS (
SELECT 0 AS _part, event_id AS _seq, ts, device, co, humidity, light, lpg, motion, smoke, temp FROM r
UNION ALL
SELECT 1 AS _part, event_id AS _seq, ts, device, co, humidity, light, lpg, motion, smoke, temp FROM r
WHERE event_id % 71 = 0
)"""


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def clean(x: str) -> str:
    return f"lower(trim({x}, {WS}))"


def missing(x: str) -> str:
    t = clean(x)
    return f"({x} IS NULL OR {t} IN ({_q(MISSING)}) OR regexp_matches({t}, '^[+-]?nan$'))"


def number(t: str) -> str:
    return (f"(CASE WHEN regexp_matches({t}, '{NUMBER}') THEN TRY_CAST({t} AS DOUBLE) "
            f"WHEN regexp_matches({t}, '^[+-]?inf(inity)?$') THEN "
            f"(CASE WHEN starts_with({t}, '-') THEN CAST('-inf' AS DOUBLE) ELSE CAST('inf' AS DOUBLE) END) END)")


def float_value(x: str) -> str:
    t = clean(x)
    return (f"(CASE WHEN {missing(x)} THEN CAST(NULL AS DOUBLE) "
            f"WHEN {t} IN ('true', 'yes') THEN 1.0 "
            f"WHEN {t} IN ('false', 'no') THEN 0.0 ELSE {number(t)} END)")


def bool_value(x: str) -> str:
    t = clean(x)
    n = number(t)
    return (f"(CASE WHEN {missing(x)} THEN CAST(NULL AS BOOLEAN) "
            f"WHEN {t} IN ('true', '1', 'yes') THEN TRUE "
            f"WHEN {t} IN ('false', '0', 'no') THEN FALSE "
            f"WHEN {n} = 1.0 THEN TRUE WHEN {n} = 0.0 THEN FALSE END)")


def issue(x: str, kind: str, value: str) -> str:
    return f"(CASE WHEN {missing(x)} THEN 'missing_measurement' WHEN {value} IS NULL THEN '{kind}' END)"


def _secs(x: str) -> str:
    return f"(CASE WHEN {x} > 1e12 THEN {x} / 1000.0 ELSE {x} END)"


def parsed_sql() -> str:
    """CTEs ``raw`` -> ``p1`` (typed cells) -> ``cls`` (classified rows)."""
    cols = []
    for f in FLOATS:
        cols.append(f"{float_value(f)} AS v_{f}")
        cols.append(f"{issue(f, 'invalid_numeric', float_value(f))} AS i_{f}")
    for f in BOOLS:
        cols.append(f"{bool_value(f)} AS v_{f}")
        cols.append(f"{issue(f, 'invalid_boolean', bool_value(f))} AS i_{f}")
    ts_num = f"(CASE WHEN NOT {missing('ts')} THEN {number(clean('ts'))} END)"
    p1 = (f"p1 AS (SELECT raw.*, {ts_num} AS ts_num, "
          f"trim(device, {WS}) AS device_t, {', '.join(cols)} FROM raw)")
    reason = (f"(CASE WHEN {missing('ts')} THEN 'missing_ts' "
              f"WHEN NOT coalesce({_secs('ts_num')} BETWEEN -62135596800.0 AND 253402300799.0, FALSE) "
              f"THEN 'invalid_ts' "
              f"WHEN {missing('device')} THEN 'missing_device' "
              f"WHEN device_t = '' THEN 'empty_device' END)")
    order = FLOATS + BOOLS
    flag_list = "[" + ", ".join(f"CASE WHEN i_{f} IS NOT NULL THEN i_{f} || '_{f}' END" for f in order) + "]"
    cls = (f"cls AS (SELECT *, {reason} AS rejection_reason, "
           f"list_filter({flag_list}, lambda x: x IS NOT NULL) AS flags FROM p1)")
    return f"{RAW_SQL},\n{p1},\n{cls}"


def readings_sql() -> str:
    """CTEs up to ``acc`` (accepted documents, duplicates kept) and ``rd`` (deduped readings)."""
    acc = ("acc AS (SELECT _part, _seq, ts_num AS timestamp_unix, device_t AS device, "
           "make_timestamp(CAST(round(" + _secs("ts_num") + " * 1e6) AS BIGINT)) AS timestamp, "
           "v_co AS co, v_humidity AS humidity, v_light AS light, v_lpg AS lpg, v_motion AS motion, "
           "v_smoke AS smoke, v_temp AS temp, len(flags) = 0 AS is_valid, flags, "
           "array_to_string(flags, ',') AS flags_text, CAST(len(flags) AS INTEGER) AS invalid_measurement_count "
           "FROM cls WHERE rejection_reason IS NULL)")
    acc2 = "acc2 AS (SELECT *, CAST(timestamp AS DATE) AS event_date FROM acc)"
    rd = ("rd AS (SELECT DISTINCT ON (device, timestamp_unix, co, humidity, light, lpg, motion, smoke, temp) * "
          "FROM acc2 ORDER BY device, timestamp_unix, co, humidity, light, lpg, motion, smoke, temp, flags_text DESC)")
    return f"{parsed_sql()},\n{acc},\n{acc2},\n{rd}"


def with_readings(select: str) -> str:
    return f"WITH {readings_sql()}\n{select}"


def with_parsed(select: str) -> str:
    return f"WITH {parsed_sql()}\n{select}"


def with_raw(select: str) -> str:
    return f"WITH {RAW_SQL}\n{select}"


def round_even(x: str, places: int) -> str:
    return (f"(CASE WHEN abs({x}) < 1e31 THEN CAST(round_even(CAST({x} AS DECIMAL(38,6)), {places}) AS DOUBLE) "
            f"ELSE CAST({x} AS DOUBLE) END)")


# The raw rows with huge and infinite cells in place of some measurements.
EXTREME_SQL = """x AS (SELECT _part, _seq, ts, device, co, humidity, light, lpg, motion,
 CASE WHEN _seq % 5 = 0 THEN 'inf' WHEN _seq % 5 = 1 THEN '3e12' ELSE smoke END AS smoke,
 CASE WHEN _seq % 7 = 0 THEN '-inf' WHEN _seq % 7 = 1 THEN '3e12' WHEN _seq % 7 = 2 THEN '1e300' ELSE temp END AS temp
 FROM raw)"""


def with_extremes(select: str) -> str:
    """``select`` over readings whose smoke and temperature hold huge and infinite values."""
    return with_readings(select).replace("FROM raw)", f"FROM x)").replace("p1 AS (SELECT raw.*", f"{EXTREME_SQL},\np1 AS (SELECT x.*")
