"""The same results in SQL, for the queries that SQL can express."""

from __future__ import annotations

FLIGHTS_RAW = """flights_raw AS (
  SELECT CAST(year(l_shipdate) AS INT) AS "Year",
         CAST(month(l_shipdate) AS INT) AS "Month",
         CAST(day(l_shipdate) AS INT) AS "DayofMonth",
         p_brand AS carrier,
         CAST(l_suppkey AS VARCHAR) AS flight_num,
         lower(sn.n_name) AS origin,
         CASE WHEN l_linenumber = 6 THEN NULL ELSE lower(cn.n_name) END AS dest,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) * 50 END AS dep_time,
         CASE WHEN l_discount = 0.0 THEN NULL
              ELSE CAST(CAST(l_quantity AS INT) - 20 AS DOUBLE) END AS dep_delay,
         CAST(datediff('day', o_orderdate, l_shipdate) AS DOUBLE) AS arr_delay,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS cancelled,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey)"""

ARRIVAL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
ARRIVAL_DESC = ", ".join(f"{c} DESC" for c in ARRIVAL.split(", "))

NORMAL_COLUMNS = """Year AS year, Month AS month, DayofMonth AS day_of_month, dep_delay, arr_delay,
         CAST(cancelled AS TINYINT) AS cancelled, upper(carrier) AS carrier, flight_num,
         upper(origin) AS origin, upper(dest) AS dest, dep_time AS dep_time_raw"""

NORMAL = f"""norm AS (SELECT {NORMAL_COLUMNS}, {ARRIVAL} FROM flights_raw)"""
SHIFTED = f"""shifted AS (SELECT * REPLACE (day_of_month + 3 AS day_of_month) FROM norm)"""

KEY_PARTS = (
    "year",
    "month",
    "day_of_month",
    "carrier",
    "flight_num",
    "origin",
    "dest",
    "dep_time_raw",
)
BUSINESS_KEY = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in KEY_PARTS)
NULL_SAFE_KEY = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in KEY_PARTS)
HASH_KEY = (
    "sha256("
    + " || '|' || ".join(
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), 'null')"
        for c in (*KEY_PARTS, "dep_delay", "arr_delay")
    )
    + ")"
)
HOUR = "CAST(greatest(0, least(23, floor(coalesce(dep_time_raw, 0) / 100))) AS INT)"
SEASON = """CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
            WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""
LATE = "CAST(CASE WHEN arr_delay > 15.0 THEN 1 ELSE 0 END AS TINYINT)"
DATE = "make_date(year, month, day_of_month)"
VALID_DAY = "day_of_month <= day(last_day(make_date(year, month, 1)))"


def silver_ctes(
    name: str = "silver",
    raw: str = "flights_raw",
    key: str = BUSINESS_KEY,
    columns: str = NORMAL_COLUMNS,
) -> str:
    return f"""{name}_norm AS (SELECT {columns}, {ARRIVAL} FROM {raw}),
{name}_clean AS (
  SELECT *, {key} AS flight_key FROM {name}_norm
  WHERE cancelled = 0 AND year IS NOT NULL AND month IS NOT NULL AND arr_delay IS NOT NULL
    AND month BETWEEN 1 AND 12 AND day_of_month BETWEEN 1 AND 31
    AND arr_delay BETWEEN -120.0 AND 360.0),
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY year, month, flight_key ORDER BY {ARRIVAL_DESC}) AS pick
  FROM {name}_clean),
{name} AS (
  SELECT flight_key, {DATE} AS flight_date, year, month, day_of_month, {HOUR} AS hour,
         CAST(isodow({DATE}) AS TINYINT) AS day_of_week, {SEASON} AS season,
         carrier, flight_num, origin, dest, origin || '_' || dest AS route, dep_delay, arr_delay,
         {LATE} AS is_delayed_15
  FROM {name}_ranked WHERE pick = 1)"""


def later_delays(name: str, minutes: int) -> str:
    """The raw flights with all arrival delays raised."""
    return f"{name} AS (SELECT * REPLACE (arr_delay + {minutes} AS arr_delay) FROM flights_raw)"


FEATURES = """features AS (
  SELECT flight_key, flight_date, year, month, hour, day_of_week, season,
         coalesce(carrier, 'UNK') AS carrier, coalesce(origin, 'UNK') AS origin,
         coalesce(dest, 'UNK') AS dest, coalesce(route, 'UNK_UNK') AS route,
         coalesce(dep_delay, 0.0) AS dep_delay, arr_delay, is_delayed_15
  FROM silver WHERE arr_delay IS NOT NULL)"""


def split_ctes(source: str) -> str:
    return f"""placed AS (
  SELECT *, row_number() OVER (ORDER BY flight_date NULLS FIRST, flight_key NULLS FIRST) AS place
  FROM {source}),
parts AS (
  SELECT *, CASE WHEN place <= (SELECT floor(count(*) * 0.8) FROM {source})
                 THEN 'train' ELSE 'test' END AS part
  FROM placed)"""


NUMBERS = ("year", "month", "hour", "day_of_week", "dep_delay")
TEXTS = ("season", "carrier", "origin", "dest", "route")

SLOTS = f"""counted AS (
  {' UNION ALL '.join(
      f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n_rows FROM parts "
      f"WHERE part = 'train' AND {c} IS NOT NULL GROUP BY {c}" for c in TEXTS)}),
graded AS (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n_rows DESC, value) AS grade,
         count(*) OVER (PARTITION BY feature) AS categories
  FROM counted),
slots AS (
  SELECT feature, value, n_rows,
         CASE WHEN categories > 50 AND grade >= 50 THEN '<rare>' ELSE value END AS slot
  FROM graded)"""

RULE_SCORES = """scores AS (
  SELECT flight_key, flight_date, arr_delay, coalesce(dep_delay, 0.0) + 100.0 AS predicted,
         least(1.0, greatest(0.0, (coalesce(dep_delay, 0.0) + 20.0) / 64.0)) AS probability,
         is_delayed_15
  FROM silver)"""

DELAY_MEASURES = """count(*) AS flights_cnt, avg(arr_delay) AS avg_arr_delay,
         avg(dep_delay) AS avg_dep_delay, avg(is_delayed_15) AS share_delayed_15"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join((FLIGHTS_RAW, *ctes)) + "\n" + select


BOOSTED = "TRUE AS loss_falls, TRUE AS beats_constant, TRUE AS rounds_valid"


def _importance_ctes() -> tuple[str, ...]:
    """The test rows in blocks by MD5, and each feature shifted 5 times by its own numbers of places."""
    columns = (*NUMBERS, *TEXTS)
    ticket = "md5(concat_ws('|', flight_key, " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + ", CAST(arr_delay AS VARCHAR)))"
    rule = "{dep_delay} * 2 + {month} * 3 + {hour} + CASE WHEN {carrier} < 'BRAND#3' THEN 10 ELSE 0 END + 60"
    digits = " + ".join(f"CASE WHEN count(*) > {4096 * 16 ** d} THEN 1 ELSE 0 END" for d in range(8))
    trials = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {1 + i * 5 + k} AS places" for i, name in enumerate(columns) for k in range(5)
    )

    def predicted(moved: str | None) -> str:
        return rule.format(**{c: f"{'n' if c == moved else 'o'}.{c}" for c in columns})

    cases = " ".join(f"WHEN '{c}' THEN {predicted(c)}" for c in columns)
    return (
        f"tested AS (SELECT *, {ticket} AS ticket FROM parts WHERE part = 'test')",
        f"cut AS (SELECT {digits} AS d FROM tested)",
        """member AS (
  SELECT *, substr(ticket, 1, d) AS block, row_number() OVER (PARTITION BY substr(ticket, 1, d) ORDER BY ticket) - 1 AS pos,
         count(*) OVER (PARTITION BY substr(ticket, 1, d)) AS size FROM tested, cut)""",
        f"trial AS ({trials})",
        f"""moved AS (
  SELECT feature, places, o.arr_delay AS actual, CASE feature {cases} END AS predicted
  FROM member o, trial, member n
  WHERE n.block = o.block AND n.pos = (o.pos + places) % o.size)""",
        """quality AS (
  SELECT feature, 1 - avg((actual - predicted) ** 2) / var_pop(actual) AS r2 FROM moved GROUP BY feature, places)""",
        f"base AS (SELECT 1 - avg((arr_delay - ({predicted(None)})) ** 2) / var_pop(arr_delay) AS r2 FROM member o)",
    )


IMPORTANCE = """SELECT feature, round((SELECT r2 FROM base) - avg(r2), 9) AS importance FROM quality GROUP BY feature"""


def _delay_by(kind: str, column: str) -> str:
    return (
        f"SELECT '{kind}' AS metric_type, CAST({column} AS VARCHAR) AS metric_key, "
        f"{DELAY_MEASURES} FROM silver WHERE arr_delay IS NOT NULL GROUP BY {column}"
    )


DIMENSIONS = {"airport": "origin", "carrier": "carrier", "hour": "hour", "season": "season"}
ANALYTICS = "\nUNION ALL\n".join(_delay_by(kind, column) for kind, column in DIMENSIONS.items())
SILVER = silver_ctes()
ALL_SILVER = with_(SILVER, select="SELECT * FROM silver")
ALL_RAW = with_(select="SELECT * FROM flights_raw")


def _normal(select: str, *more: str) -> str:
    return with_(NORMAL, *more, select=select)


def _z_value(columns: tuple[str, ...]) -> str:
    """Interleaved bits of the numbers of 256 ranges of distinct values at most."""
    codes = ", ".join(
        f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 + (dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1) "
        f"// (SELECT greatest(1, CAST(ceil(count(DISTINCT {c}) / 256.0) AS BIGINT)) FROM silver) END AS c{i}"
        for i, c in enumerate(columns)
    )
    bits = " + ".join(
        f"(((c{i} >> {b}) & 1) << {b * len(columns) + i})"
        for i in range(len(columns))
        for b in range(12)
    )
    return f"SELECT * EXCLUDE ({', '.join(f'c{i}' for i in range(len(columns)))}), CAST({bits} AS BIGINT) AS z_value FROM (SELECT *, {codes} FROM silver)"


def _training(runs: dict[str, str], n_metrics: int = 3) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS run_name, '{target}' AS target, "
        "count(*) FILTER (part = 'train') AS train_rows, "
        "count(*) FILTER (part = 'test') AS test_rows, "
        f"CAST(10 AS INT) AS n_importances, CAST({n_metrics} AS INT) AS n_metrics, "
        "TRUE AS metrics_repeat FROM parts"
        for name, target in runs.items()
    )
    return with_(SILVER, FEATURES, split_ctes("features"), select=rows)


def oracle_sql() -> dict[str, str]:
    sql = {
        # Scans
        "scan_parquet": "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem",
        "scan_csv": with_(
            select="SELECT "
            + ", ".join(
                f'CAST({c} AS VARCHAR) AS {c}'
                for c in (
                    '"Year" "Month" "DayofMonth" carrier flight_num origin dest dep_time dep_delay arr_delay cancelled '
                    + ARRIVAL.replace(",", "")
                ).split()
            )
            + " FROM flights_raw"
        ),
        "list_batches": with_(select="SELECT DISTINCT Year AS year, Month AS month FROM flights_raw"),
        "batch_counts": with_(
            select="""SELECT Year AS year, Month AS month, count(*) AS rows FROM flights_raw
GROUP BY GROUPING SETS ((Year), (Year, Month))"""
        ),
        # Bronze
        "bronze_append": ALL_RAW,
        "stream_load": ALL_RAW,
        "bronze_max_year": with_(select="SELECT * FROM flights_raw WHERE Year <= 1997"),
        "bronze_reset": with_(
            select="""SELECT Year AS year, Month AS month, count(*) AS rows FROM flights_raw
WHERE Year <= 1997 GROUP BY GROUPING SETS ((Year), (Year, Month))"""
        ),
        "bronze_idempotent_rerun": with_(
            select="""SELECT Year AS year, Month AS month, count(*) AS rows,
  CASE WHEN Year <= 1997 THEN 'skipped' ELSE 'written' END AS status, count(*) AS stored_rows
FROM flights_raw GROUP BY Year, Month"""
        ),
        "bronze_load_result": with_(
            select="""SELECT
  (SELECT string_agg(CAST(y AS VARCHAR), ',' ORDER BY y)
   FROM (SELECT DISTINCT Year AS y FROM flights_raw WHERE Year > 1997)) AS years_written,
  count(*) AS source_rows, count(*) FILTER (Year > 1997) AS written_rows,
  count(*) FILTER (Year <= 1997) AS skipped_rows, CAST(0 AS BIGINT) AS rejected_rows, CAST(0 AS BIGINT) AS malformed_rows,
  count(DISTINCT Year * 100 + Month) AS versions FROM flights_raw"""
        ),
        "bronze_reconcile": with_(
            select="""SELECT count(*) AS source_rows, count(*) AS written_rows,
  CAST(0 AS BIGINT) AS skipped_rows, CAST(0 AS BIGINT) AS rejected_rows, CAST(0 AS BIGINT) AS malformed_rows,
  count(DISTINCT Year * 100 + Month) AS versions,
  TRUE AS rows_match, TRUE AS has_version, TRUE AS versions_cover_years FROM flights_raw"""
        ),
        "bronze_quarantine": with_(
            select="""SELECT CASE l_linenumber WHEN 4 THEN 'short' WHEN 5 THEN 'long' ELSE 'sound' END AS kind,
  Year AS year, Month AS month, count(*) AS rows FROM flights_raw GROUP BY 1, 2, 3"""
        ),
        # Normalisation
        "resolve_columns": _normal("SELECT * FROM norm"),
        "safe_casts": with_(
            select=f"""SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE Year END AS year,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE Month END AS month, DayofMonth AS day_of_month,
  dep_delay, CASE WHEN l_linenumber = 5 THEN NULL ELSE arr_delay END AS arr_delay,
  CAST(CASE WHEN l_linenumber = 4 THEN NULL ELSE cancelled END AS TINYINT) AS cancelled,
  upper(carrier) AS carrier, flight_num, upper(origin) AS origin, upper(dest) AS dest,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE dep_time END AS dep_time_raw, {ARRIVAL}
FROM flights_raw"""
        ),
        "default_columns": with_(
            select=f"""SELECT Year AS year, Month AS month, CAST(1 AS INT) AS day_of_month,
  CAST(NULL AS DOUBLE) AS dep_delay, arr_delay, CAST(0 AS TINYINT) AS cancelled, 'UNK' AS carrier,
  'UNK' AS flight_num, 'UNK' AS origin, 'UNK' AS dest, CAST(NULL AS INT) AS dep_time_raw, {ARRIVAL}
FROM flights_raw"""
        ),
        # Filters
        "filter_cancelled": _normal("SELECT * FROM norm WHERE cancelled = 0"),
        "filter_required": _normal("SELECT * FROM norm WHERE arr_delay <= 200"),
        "filter_non_null_target": _normal("SELECT * FROM norm WHERE arr_delay <= 200"),
        "filter_outliers": _normal("SELECT * FROM norm WHERE arr_delay BETWEEN -120 AND 360"),
        "filter_calendar": _normal(
            "SELECT * FROM shifted WHERE month BETWEEN 1 AND 12 AND day_of_month BETWEEN 1 AND 31",
            SHIFTED,
        ),
        "filter_valid_date": _normal(f"SELECT * FROM shifted WHERE {VALID_DAY}", SHIFTED),
        "filter_batch": with_(
            SILVER, select="SELECT * FROM silver WHERE year = 1997 AND month = 3"
        ),
        "clean_funnel": _normal(
            f"""SELECT count(*) AS raw,
  count(*) FILTER (cancelled = 0) AS after_cancelled,
  count(*) FILTER (cancelled = 0 AND arr_delay IS NOT NULL) AS after_required,
  count(*) FILTER (cancelled = 0 AND arr_delay IS NOT NULL AND day_of_month <= 31) AS after_calendar,
  count(*) FILTER (cancelled = 0 AND arr_delay BETWEEN -120 AND 360 AND day_of_month <= 31)
    AS after_outliers,
  count(*) FILTER (cancelled = 0 AND arr_delay BETWEEN -120 AND 360 AND {VALID_DAY})
    AS after_valid_date FROM shifted""",
            SHIFTED,
        ),
        # Scalar functions
        "season": _normal(f"SELECT {ARRIVAL}, month, {SEASON} AS season FROM norm"),
        "dep_hour": _normal(f"SELECT {ARRIVAL}, dep_time_raw, {HOUR} AS hour FROM norm"),
        "flight_date": _normal(
            f"""SELECT {ARRIVAL}, year, month, day_of_month,
  CASE WHEN {VALID_DAY} THEN {DATE} END AS flight_date FROM shifted""",
            SHIFTED,
        ),
        "day_of_week": _normal(
            f"""SELECT {ARRIVAL}, {DATE} AS flight_date,
  CAST(isodow({DATE}) AS TINYINT) AS day_of_week FROM norm"""
        ),
        "route": _normal(f"SELECT {ARRIVAL}, origin, dest, origin || '_' || dest AS route FROM norm"),
        "is_delayed_15": _normal(f"SELECT {ARRIVAL}, arr_delay, {LATE} AS is_delayed_15 FROM norm"),
        "upper_codes": _normal(f"SELECT {ARRIVAL}, carrier, origin, dest FROM norm"),
        "business_key": _normal(
            f"SELECT {ARRIVAL}, {BUSINESS_KEY} AS flight_key, {NULL_SAFE_KEY} AS null_safe_key FROM norm"
        ),
        "row_hash_key": _normal(f"SELECT {ARRIVAL}, {HASH_KEY} AS flight_key FROM norm"),
        "row_ordinal_key": with_(
            select="SELECT count(*) AS n_rows, count(*) AS n_keys FROM flights_raw"
        ),
        "fill_nulls": _normal(
            f"""SELECT {ARRIVAL}, coalesce(carrier, 'UNK') AS carrier,
  coalesce(origin, 'UNK') AS origin, coalesce(dest, 'UNK') AS dest,
  coalesce(origin || '_' || dest, 'UNK_UNK') AS route, coalesce(dep_delay, 0.0) AS dep_delay
FROM norm"""
        ),
        # Silver
        "dedupe_keep_last": _normal(
            f"""SELECT {ARRIVAL}, flight_key FROM (
  SELECT *, row_number() OVER (PARTITION BY year, month, flight_key ORDER BY {ARRIVAL_DESC}) AS pick
  FROM (SELECT *, {BUSINESS_KEY} AS flight_key FROM norm)) WHERE pick = 1"""
        ),
        "silver_build": ALL_SILVER,
        "silver_null_safe_key": with_(
            silver_ctes(key=NULL_SAFE_KEY), select="SELECT * FROM silver"
        ),
        "silver_no_dep_time": with_(
            silver_ctes(
                key=" || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in KEY_PARTS if c != "dep_time_raw"),
                columns=NORMAL_COLUMNS.replace("dep_time AS", "CAST(NULL AS INT) AS"),
            ),
            select="SELECT * FROM silver",
        ),
        "silver_hash_key": with_(
            silver_ctes(
                key=HASH_KEY,
                columns=NORMAL_COLUMNS.replace("flight_num", "'UNK' AS flight_num"),
            ),
            select="SELECT * FROM silver",
        ),
        "silver_first_write": ALL_SILVER,
        "silver_append": ALL_SILVER,
        "silver_upsert": with_(
            later_delays("late_raw", 200),
            silver_ctes("target", "late_raw"),
            silver_ctes("source"),
            select="""SELECT * FROM source WHERE year <= 1997
UNION ALL
SELECT * FROM target t WHERE year > 1997 OR flight_key IS NULL
  OR NOT EXISTS (SELECT 1 FROM source s WHERE s.flight_key = t.flight_key)""",
        ),
        "silver_stream": with_(
            later_delays("late_raw", 200),
            silver_ctes("target", "late_raw"),
            silver_ctes("source"),
            select="""SELECT * FROM source WHERE year <= 1997
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.year <= 1997 AND s.year = t.year AND s.month = t.month
    AND s.flight_key IS NOT DISTINCT FROM t.flight_key)""",
        ),
        "silver_build_result": with_(
            SILVER,
            select="""SELECT (SELECT count(*) FROM flights_raw) AS input_rows,
  count(*) AS output_rows, 'merge' AS written_mode,
  CAST(count(DISTINCT year * 100 + month) FILTER (year <= 1997)
       + count(DISTINCT year * 100 + month) - 1 AS INT) AS version FROM silver""",
        ),
        "silver_changed_months": with_(
            SILVER,
            select="""SELECT year, month, count(*) AS rows,
  CAST(CASE WHEN year = 1997 AND month = 3 THEN 2 ELSE 1 END AS BIGINT) AS writes,
  'merge' AS late_mode,
  (SELECT count(*) FROM flights_raw WHERE Year = 1997 AND Month = 3) AS late_input_rows,
  'skip' AS last_mode, CAST(0 AS BIGINT) AS last_input_rows
FROM silver GROUP BY year, month""",
        ),
        # Gold
        "gold_analytics": with_(SILVER, select=ANALYTICS),
        "gold_analytics_write": with_(SILVER, select=ANALYTICS),
        "union_relaxed": with_(
            SILVER,
            select="""SELECT 'hour' AS kind, count(*) AS n_rows, CAST(sum(hour) AS DOUBLE) AS sum_value
FROM silver UNION ALL SELECT 'dep_delay', count(*), sum(dep_delay) FROM silver
UNION ALL SELECT 'is_delayed_15', count(*), CAST(sum(is_delayed_15) AS DOUBLE) FROM silver""",
        ),
        "carrier_avg_delay": with_(
            SILVER,
            select="""SELECT carrier, avg(arr_delay) AS avg_arr_delay FROM silver
WHERE year = 1997 AND arr_delay > 15.0 GROUP BY carrier""",
        ),
        "carrier_avg_delay_month": with_(
            SILVER,
            select="""SELECT carrier, avg(arr_delay) AS avg_arr_delay FROM silver
WHERE year = 1997 AND month = 1 AND arr_delay > 15.0 GROUP BY carrier""",
        ),
        "gold_features": with_(SILVER, FEATURES, select="SELECT * FROM features"),
        "gold_features_write": with_(SILVER, FEATURES, select="SELECT * FROM features"),
        "explain_query": """SELECT TRUE AS partition_filters, TRUE AS pushed_filter,
  'struct<carrier:string,arr_delay:double>' AS read_schema""",
        # Versioned tables
        "time_travel": with_(
            later_delays("late_raw", 100),
            silver_ctes(raw="late_raw"),
            select="SELECT * FROM silver WHERE year <= 1997",
        ),
        "table_version": with_(
            select="""SELECT CAST(count(DISTINCT Year * 100 + Month) - 1 AS INT) AS version,
  count(DISTINCT Year * 100 + Month) AS versions FROM flights_raw"""
        ),
        "compact": ALL_SILVER,
        "compact_report": with_(
            SILVER,
            select="""SELECT (SELECT count(*) FROM (
    SELECT year, month FROM silver GROUP BY year, month
    HAVING count(DISTINCT is_delayed_15) = 2)) AS batches_rewritten,
  TRUE AS fewer, count(*) AS rows FROM silver""",
        ),
        "z_order": with_(SILVER, select=_z_value(("year", "month", "origin", "dest", "carrier"))),
        "z_order_rewrite": ALL_SILVER,
        "sort_cluster": ALL_SILVER,
        "vacuum": with_(
            SILVER, select="SELECT DISTINCT year, month FROM silver WHERE year <= 1997"
        ),
        "schema_evolution": with_(
            SILVER,
            select="""SELECT *, CASE WHEN year <= 1997 THEN 'init' END AS pipeline_run_id
FROM silver""",
        ),
        "maintenance_report": with_(
            SILVER,
            select="""SELECT (SELECT count(*) FROM silver GROUP BY year, month
   ORDER BY year, month LIMIT 1) AS time_travel_rows,
  count(*) AS compaction_rows, count(*) AS z_order_rows, CAST(168 AS BIGINT) AS retention_hours
FROM silver""",
        ),
        # Models
        "ml_matrix": with_(
            SILVER,
            FEATURES,
            select=f"SELECT {', '.join(NUMBERS + TEXTS)}, is_delayed_15 FROM features",
        ),
        "ml_row_cap": with_(
            SILVER,
            FEATURES,
            select="""SELECT * FROM features
ORDER BY flight_date NULLS FIRST, flight_key NULLS FIRST LIMIT 3000""",
        ),
        "time_split": with_(
            SILVER,
            FEATURES,
            split_ctes("features"),
            select="SELECT flight_key, flight_date, route, arr_delay, part FROM parts",
        ),
        "impute_median": with_(
            SILVER,
            split_ctes("silver"),
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS feature, CAST(median({c}) AS DOUBLE) AS median FROM parts "
                "WHERE part = 'train'"
                for c in NUMBERS
            ),
        ),
        "impute_mode": with_(
            SILVER,
            split_ctes("silver"),
            SLOTS,
            select="SELECT feature, value AS most_frequent FROM graded WHERE grade = 1",
        ),
        "one_hot": with_(SILVER, split_ctes("silver"), SLOTS, select="SELECT * FROM slots"),
        "preprocessor": with_(
            SILVER,
            split_ctes("silver"),
            SLOTS,
            "fills AS (SELECT feature, value FROM graded WHERE grade = 1)",
            "filled AS (SELECT * REPLACE ("
            + ", ".join(
                f"coalesce({c}, (SELECT value FROM fills WHERE feature = '{c}')) AS {c}"
                for c in TEXTS
            )
            + ", "
            + ", ".join(
                f"coalesce(CAST({c} AS DOUBLE), (SELECT CAST(median({c}) AS DOUBLE) FROM parts "
                f"WHERE part = 'train')) AS {c}"
                for c in NUMBERS
            )
            + ") FROM parts WHERE part = 'test')",
            select=f"SELECT flight_key, flight_date, arr_delay, {', '.join(NUMBERS)}, "
            + ", ".join(f"s_{c}.slot AS {c}_slot" for c in TEXTS)
            + ", CAST("
            + " + ".join(f"CASE WHEN s_{c}.slot IS NULL THEN 0 ELSE 1 END" for c in TEXTS)
            + " AS INT) AS hot FROM filled "
            + " ".join(
                f"LEFT JOIN slots s_{c} ON s_{c}.feature = '{c}' AND s_{c}.value = filled.{c}"
                for c in TEXTS
            ),
        ),
        "predict_threshold": with_(
            SILVER,
            RULE_SCORES,
            select="""SELECT *, CAST(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS INT) AS label
FROM scores""",
        ),
        "regression_metrics": with_(
            SILVER,
            RULE_SCORES,
            select="""SELECT round(avg(abs(arr_delay - predicted)), 9) AS mae,
  round(sqrt(avg((arr_delay - predicted) * (arr_delay - predicted))), 9) AS rmse,
  round(1 - sum((arr_delay - predicted) * (arr_delay - predicted))
        / sum((arr_delay - mean) * (arr_delay - mean)), 9) AS r2
FROM scores, (SELECT avg(arr_delay) AS mean FROM scores)""",
        ),
        "run_log": with_(
            SILVER,
            RULE_SCORES,
            """measured AS (
  SELECT avg(abs(arr_delay - predicted)) AS mae,
         avg((arr_delay - predicted) * (arr_delay - predicted)) AS mse,
         var_pop(arr_delay) AS spread FROM scores)""",
            select=" UNION ALL ".join(
                f"SELECT 'regression_rule' AS run_name, 'arr_delay' AS target, '{name}' AS metric, "
                f"round({value}, 9) AS value FROM measured"
                for name, value in (("mae", "mae"), ("rmse", "sqrt(mse)"), ("r2", "1 - mse / spread"))
            ),
        ),
        "classification_metrics": with_(
            SILVER,
            RULE_SCORES,
            """tallies AS (
  SELECT probability AS score, count(*) FILTER (is_delayed_15 = 1) AS pos,
         count(*) FILTER (is_delayed_15 = 0) AS neg FROM scores GROUP BY probability)""",
            """curve AS (
  SELECT score, pos, neg,
         sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(neg) OVER (ORDER BY score) - neg AS beaten, sum(pos) OVER () AS all_pos,
         sum(neg) OVER () AS all_neg FROM tallies)""",
            select="""SELECT
  round(sum(pos * (beaten + neg / 2.0)) / max(CAST(all_pos AS DOUBLE) * all_neg), 9) AS roc_auc,
  round((SELECT 2.0 * count(*) FILTER (probability >= 0.5 AND is_delayed_15 = 1)
           / (count(*) FILTER (probability >= 0.5) + count(*) FILTER (is_delayed_15 = 1))
         FROM scores), 9) AS f1,
  round(sum(CAST(pos AS DOUBLE) / all_pos * tp / (tp + fp)), 9) AS pr_auc FROM curve""",
        ),
        "save_model": with_(
            SILVER,
            FEATURES,
            split_ctes("features"),
            select="SELECT count(*) AS n_rows, count(*) AS n_same FROM parts WHERE part = 'test'",
        ),
        "train_regression": _training(
            {
                "regression_linear_regression": "arr_delay",
                "regression_hgb_regressor": "arr_delay",
            }
        ),
        "train_classification": _training(
            {
                "classification_logistic_regression": "is_delayed_15",
                "classification_gb_classifier": "is_delayed_15",
            }
        ),
        "feature_lineage": with_(
            SILVER,
            select="""SELECT 'regression_linear_regression' AS run_name,
  CAST(0 AS INT) AS feature_table_version, TRUE AS version_known,
  (SELECT count(*) FROM silver WHERE year <= 1997) AS rows_read""",
        ),
        **{
            name: with_(
                SILVER,
                FEATURES,
                split_ctes("features"),
                select="SELECT count(*) FILTER (part = 'train') AS n_train, "
                f"count(*) FILTER (part = 'test') AS n_test, {more} FROM parts",
            )
            for name, more in {
                "fit_linear": "TRUE AS residuals_balanced, TRUE AS all_scored, "
                "round(regr_slope(arr_delay, dep_delay) FILTER (part = 'train'), 4) AS slope, "
                "round(regr_intercept(arr_delay, dep_delay) FILTER (part = 'train'), 3) AS intercept",
                "fit_logistic": "TRUE AS scores_balanced, TRUE AS probabilities_valid",
                "fit_gbt_reg": BOOSTED,
                "fit_gbt_cls": BOOSTED,
            }.items()
        },
        "permutation_importance": with_(
            SILVER, FEATURES, split_ctes("features"), *_importance_ctes(), select=IMPORTANCE
        ),
        "full_run": with_(
            SILVER,
            FEATURES,
            f"mart AS ({ANALYTICS})",
            select="""SELECT (SELECT count(*) FROM flights_raw) AS source_rows,
  CAST(0 AS BIGINT) AS skipped_rows, CAST(0 AS BIGINT) AS rejected_rows, CAST(0 AS BIGINT) AS malformed_rows,
  (SELECT count(*) FROM flights_raw) AS bronze_rows,
  (SELECT CAST(count(DISTINCT Year * 100 + Month) - 1 AS INT) FROM flights_raw) AS bronze_version,
  (SELECT count(*) FROM silver) AS silver_rows,
  (SELECT CAST(count(DISTINCT year * 100 + month) - 1 AS INT) FROM silver) AS silver_version,
  (SELECT count(*) FROM mart) AS gold_analytics_rows, CAST(0 AS INT) AS gold_analytics_version,
  (SELECT count(*) FROM features) AS gold_features_rows, CAST(0 AS INT) AS gold_features_version,
  CAST(4 AS BIGINT) AS training_runs""",
        ),
    }
    for kind, column in DIMENSIONS.items():
        sql[f"delay_by_{kind}"] = with_(SILVER, select=_delay_by(kind, column))
    return sql
