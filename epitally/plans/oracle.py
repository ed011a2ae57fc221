"""ANSI-SQL twins of the catalogue, for DuckDB on the same tables."""

from __future__ import annotations

from epitally.schema import (
    COLUMNS,
    FEATURES,
    NARROW,
    REPORT_COLUMNS,
    REQUIRED,
    STRICT_FEATURES,
)

SNAPSHOT = """
o AS (
  SELECT o_custkey, MAX(epoch_ms(o_orderdate)) AS updated, COUNT(*) AS tests,
    SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS critical
  FROM orders GROUP BY o_custkey),
l AS (
  SELECT o_custkey, COUNT(*) AS cases,
    SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS deaths,
    SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS recovered,
    SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS active
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
b AS (
  SELECT o.updated, c_name AS country, n_name AS iso2, CONCAT(n_name, '_3') AS iso3,
    r_name AS continent, CAST(1000 + c_custkey AS BIGINT) AS population,
    l.cases, l.deaths, l.recovered, l.active, o.critical, o.tests
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN o ON o.o_custkey = c_custkey
  LEFT JOIN l ON l.o_custkey = c_custkey),
snap AS (
  SELECT CAST(updated AS BIGINT) AS updated, country, iso2, iso3, continent, population,
    CAST(cases AS BIGINT) AS cases, CAST(deaths AS BIGINT) AS deaths,
    CAST(recovered AS BIGINT) AS recovered,
    CAST(CASE WHEN population % 5 = 0 THEN NULL ELSE active END AS BIGINT) AS active,
    CAST(critical AS BIGINT) AS critical, CAST(tests AS BIGINT) AS tests,
    CAST(FLOOR(cases * 1000000.0E0 / population) AS BIGINT) AS "casesPerOneMillion",
    CAST(FLOOR(deaths * 1000000.0E0 / population) AS BIGINT) AS "deathsPerOneMillion"
  FROM b)"""


def _rates() -> str:
    return """
    CAST(FLOOR(cases * 1000000.0E0 / population) AS BIGINT) AS "casesPerOneMillion",
    CAST(FLOOR(deaths * 1000000.0E0 / population) AS BIGINT) AS "deathsPerOneMillion\""""


ORDERED = f"""
ordered_counts AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS country,
    CAST(epoch_ms(date_trunc('month', o_orderdate)) AS BIGINT) AS updated,
    MIN(o_orderstatus) AS iso2,
    CASE WHEN BOOL_OR(o_orderpriority = '1-URGENT') THEN 'URGENT' ELSE 'NORMAL' END AS iso3,
    CAST(1000 + o_custkey AS BIGINT) AS population, COUNT(*) AS cases,
    CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS deaths,
    CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS recovered,
    CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS active,
    CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS critical,
    COUNT(o_totalprice) AS tests
  FROM orders GROUP BY o_custkey, date_trunc('month', o_orderdate)),
ordered AS (
  SELECT updated, country, iso2, iso3, 'ORDERED' AS continent, population, cases, deaths,
    recovered, active, critical, tests, {_rates()}
  FROM ordered_counts)"""


def _shipped(name: str, keys: str, extra: str, active: str) -> str:
    return f"""
{name}_counts AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS country,
    CAST(epoch_ms(date_trunc('month', l_shipdate)) AS BIGINT) AS updated, {extra}
    MIN(l_linestatus) AS iso2, MAX(l_returnflag) AS iso3,
    CAST(1000 + o_custkey AS BIGINT) AS population, COUNT(*) AS cases,
    CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS deaths,
    CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS recovered,
    CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS counted_active,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS critical,
    COUNT(l_linenumber) AS tests
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY {keys}, date_trunc('month', l_shipdate)),
{name} AS (
  SELECT updated, country, iso2, iso3, 'SHIPPED' AS continent, population, cases, deaths,
    recovered, {active} AS active, critical, tests, {_rates()},
    {"sequence" if extra else "0 AS sequence"}
  FROM {name}_counts)"""


SHIPPED = _shipped(
    "shipped",
    "o_custkey",
    "",
    "CASE WHEN (updated // 86400000) % 7 = 0 THEN NULL ELSE counted_active END",
)
FEED = _shipped("feed", "l_orderkey, o_custkey", "l_orderkey AS sequence,", "counted_active")
LATEST = """
latest AS (
  SELECT * FROM feed
  QUALIFY ROW_NUMBER() OVER (PARTITION BY country, updated ORDER BY sequence DESC) = 1)"""

SERIES = """
series AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS country,
    CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS updated, COUNT(*) AS cases,
    CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS deaths,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS recovered
  FROM events GROUP BY user_id, date_trunc('day', ts))"""

PREDICTED = """
predicted AS (
  SELECT country, deaths AS label,
    CAST(cases AS DOUBLE) * 0.35E0 - 9.0E0 AS prediction
  FROM snap WHERE deaths IS NOT NULL)"""


def _list(columns, prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in columns)


def _complete(features) -> str:
    return " AND ".join(f'"{c}" IS NOT NULL' for c in features)


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _snap(body: str, *more: str) -> str:
    return _with([SNAPSHOT, *more], body)


SUMMARY = """COUNT(*) AS total_countries, CAST(SUM(cases) AS BIGINT) AS global_cases,
  CAST(SUM(deaths) AS BIGINT) AS global_deaths,
  CAST(SUM(population) AS BIGINT) AS global_population,
  ROUND(AVG("deathsPerOneMillion"), 2) AS avg_deaths_per_million"""

NULLS = ", ".join(
    f'CAST(COALESCE(SUM(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)'
    f' AS "{c}_nulls"'
    for c in REQUIRED
)
SIZE = f"COUNT(*) AS row_count, CAST({len(COLUMNS)} AS BIGINT) AS column_count"
RANGES = """MIN(cases) AS min_cases, MAX(cases) AS max_cases,
  ROUND(AVG(population), 6) AS avg_population"""


def _check(name: str, severity: str, value: str, passed: str = "TRUE") -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{severity}' AS severity,"
        f" ROUND(CAST({value} AS DOUBLE), 6) AS value, COALESCE({passed}, FALSE) AS passed FROM p"
    )


def _checks(absent: tuple[str, ...], limited: bool) -> str:
    present = [c for c in REQUIRED if c not in absent]
    rules = {
        "active_nulls": "row_count = 0 OR active_nulls <= 0.1E0 * row_count",
        "cases_nulls": "row_count = 0 OR cases_nulls <= 0.5E0 * row_count",
        "min_cases": "min_cases >= 0",
        "avg_population": "avg_population <= 1.0E9",
    }
    rows = [
        _check("non_empty", "error", "row_count", "row_count > 0"),
        _check("enough_rows", "warn", "row_count", "row_count >= 10"),
        *[
            _check(f"has_{c}", "error", "0" if c in absent else "1", str(c not in absent).upper())
            for c in REQUIRED
        ],
    ]
    for name in [*(f"{c}_nulls" for c in present), "min_cases", "max_cases", "avg_population"]:
        if limited and name in rules:
            rows.append(_check(name, "error", f'"{name}"', rules[name]))
        else:
            rows.append(_check(name, "info", f'"{name}"'))
    return _snap(
        "\nUNION ALL ".join(rows), f"\np AS (SELECT {SIZE}, {NULLS}, {RANGES} FROM snap)"
    )


def _merge(target: str, staging: str, update, insert, columns) -> str:
    picks = []
    for c in columns:
        if c in ("country", "updated"):
            picks.append(f"COALESCE(t.{c}, s.{c}) AS {c}")
        elif c in update:
            picks.append(f'CASE WHEN s.country IS NOT NULL THEN s."{c}" ELSE t."{c}" END AS "{c}"')
        elif c in insert:
            picks.append(f'CASE WHEN t.country IS NULL THEN s."{c}" ELSE t."{c}" END AS "{c}"')
        else:
            picks.append(f't."{c}" AS "{c}"')
    return (
        f"SELECT {', '.join(picks)} FROM {target} t FULL OUTER JOIN {staging} s "
        "ON t.country = s.country AND t.updated = s.updated"
    )


NINE = (
    "iso2",
    "iso3",
    "continent",
    "population",
    "cases",
    "deaths",
    "recovered",
    "active",
    "critical",
)
FIVE = ("cases", "deaths", "recovered", "active", "critical")
VALUES = tuple(c for c in COLUMNS if c not in ("country", "updated"))

ALL_ROWS = _snap(f"SELECT {_list(COLUMNS)} FROM snap")
NARROW_ROWS = _snap(f"SELECT {_list(NARROW.fieldNames())} FROM snap")

DAY_TABLES = """
ordered_days AS (SELECT *, tests AS today_cases, critical AS today_deaths FROM ordered),
shipped_days AS (SELECT *, cases - deaths AS today_cases, deaths AS today_deaths FROM shipped)"""

BUCKET = (
    "CAST('0x' || SUBSTR(MD5(CONCAT_WS('|', country, CAST(updated AS VARCHAR)) || '42'), 1, 8)"
    " AS BIGINT) % 10000"
)
PLACE = (
    "CAST('0x' || SUBSTR(MD5(CONCAT_WS('|', country, CAST(updated AS VARCHAR)) || '42'), 1, 15)"
    " AS BIGINT)"
)

# What a row must not be, by rule, in the rules' order.
BROKEN_IF = {
    "country_missing": "country IS NULL",
    "updated_missing": "updated IS NULL",
    **{
        f"{c}_negative": f"{c} < 0"
        for c in ("cases", "deaths", "recovered", "active", "critical", "tests", "population")
    },
    "deaths_over_cases": "deaths > cases",
    "recovered_over_cases": "recovered > cases",
    "critical_over_active": "critical > active",
    "active_missing": "active IS NULL",
    "few_tests": "tests < 10",
    "many_recovered": "recovered * 4 > cases",
}
BROKEN = "CONCAT_WS(',', " + ", ".join(
    f"CASE WHEN {condition} THEN '{name}' END" for name, condition in BROKEN_IF.items()
) + ")"

USABLE = f"{_complete(FEATURES)} AND deaths IS NOT NULL"


def _vectors(features) -> str:
    spread = ", ".join(
        f'CAST("{c}" AS DOUBLE) AS "f{i}_{c}"' for i, c in enumerate(features)
    )
    return _snap(f"SELECT country, deaths AS label, {spread} FROM snap WHERE {_complete(features)}")


METRICS = """ROUND(SQRT(AVG((label - prediction) * (label - prediction))), 6) AS rmse,
  ROUND(AVG(ABS(label - prediction)), 6) AS mae,
  ROUND(1 - SUM((label - prediction) * (label - prediction))
    / (VAR_POP(label) * COUNT(label)), 6) AS r2"""
TARGETS = """ROUND(AVG(label), 6) AS avg_actual, ROUND(AVG(prediction), 6) AS avg_predicted,
  CAST(MIN(label) AS DOUBLE) AS min_actual, CAST(MAX(label) AS DOUBLE) AS max_actual"""


def _measured(columns: str) -> str:
    return _snap(f"SELECT {columns} FROM predicted", PREDICTED)


TEST_ROWS = f"FROM snap WHERE {USABLE} AND {BUCKET} >= 8000"

# What holds of predictions that follow the labels.
FOLLOWS = "TRUE AS correlated, TRUE AS beats_the_mean, TRUE AS rmse_bounded"

ORACLE: dict[str, str] = {
    "global_summary": _snap(f"SELECT {SUMMARY} FROM snap"),
    "continent_summary": _snap(f"SELECT continent, {SUMMARY} FROM snap GROUP BY continent"),
    "wide_summary": _snap(
        """SELECT CAST(SUM(cases) AS VARCHAR) AS global_cases,
        CAST(SUM(deaths) AS VARCHAR) AS global_deaths,
        CAST(SUM(population) AS VARCHAR) AS global_population FROM snap"""
    ),
    "top_countries": _snap(
        f"SELECT {_list(REPORT_COLUMNS)} FROM snap "
        "ORDER BY cases DESC NULLS LAST, country LIMIT 20"
    ),
    "epidemic_view": _snap(f"SELECT {_list(REPORT_COLUMNS)} FROM snap"),
    "per_million_rates": _with(
        [ORDERED],
        """SELECT country, updated,
        CAST(recovered * 1000000 // population AS BIGINT) AS recovered_per_million,
        CAST(tests * 1000000 // population AS BIGINT) AS tests_per_million FROM ordered""",
    ),
    "trend": _with(
        [SERIES],
        """SELECT country, updated, cases, deaths, recovered,
        LAG(updated) OVER w AS previous_updated, cases - LAG(cases) OVER w AS cases_change,
        deaths - LAG(deaths) OVER w AS deaths_change,
        recovered - LAG(recovered) OVER w AS recovered_change
        FROM series WINDOW w AS (PARTITION BY country ORDER BY updated)""",
    ),
    "row_column_count": _snap(f"SELECT {SIZE} FROM snap"),
    "null_profile": _snap(f"SELECT {NULLS} FROM snap"),
    "range_stats": _snap(f"SELECT {RANGES} FROM snap"),
    "profile_one_pass": _snap(f"SELECT {SIZE}, {NULLS}, {RANGES} FROM snap"),
    "quality_checks": _checks((), True),
    "observed_checks": _checks((), True),
    "quarantine_rows": _snap(f"SELECT {_list(COLUMNS)}, {BROKEN} AS broken FROM snap"),
    "quarantine_counts": _snap(
        "SELECT '(all)' AS rule, COUNT(*) AS row_count FROM snap UNION ALL "
        f"SELECT '(bad)', COUNT(*) FROM snap WHERE {BROKEN} <> ''"
        + "".join(
            f" UNION ALL SELECT '{name}', COUNT(*) FROM snap WHERE {condition}"
            for name, condition in BROKEN_IF.items()
        )
    ),
    "missing_column_checks": _checks(("critical", "tests"), False),
    "key_checks": _with(
        [
            FEED,
            """
k AS (
  SELECT country IS NULL OR updated IS NULL AS null_key, COUNT(*) AS copies
  FROM feed GROUP BY country, updated),
p AS (
  SELECT COALESCE(SUM(CASE WHEN null_key THEN copies END), 0) AS null_keys,
    COALESCE(SUM(CASE WHEN NOT null_key THEN copies - 1 END), 0) AS repeats FROM k)""",
        ],
        _check("keys_not_null", "error", "null_keys", "null_keys = 0")
        + "\nUNION ALL "
        + _check("keys_unique", "error", "repeats", "repeats = 0"),
    ),
    "landing_lines": ALL_ROWS,
    "landing_array_lines": ALL_ROWS,
    "landing_documents": ALL_ROWS,
    "landing_inferred": ALL_ROWS,
    "landing_day_counters": _snap(
        f"""SELECT {_list(COLUMNS)}, cases - recovered AS "todayCases",
        deaths AS "todayDeaths" FROM snap"""
    ),
    "landing_fractions": _snap(
        """SELECT CAST(SUM(CASE WHEN population % 3 = 0 AND cases IS NOT NULL
          THEN 1 ELSE 0 END) AS BIGINT) AS cases_fractions,
        CAST(0 AS BIGINT) AS deaths_fractions, CAST(SUM(cases) AS BIGINT) AS cases_total
        FROM snap"""
    ),
    "landing_exact": _snap(
        "SELECT country, population, CAST(9007199254740993 + population AS BIGINT) AS cases FROM snap"
    ),
    "landing_rejects": _snap(
        """SELECT 'read' AS kind, country AS value FROM snap WHERE population % 7 <> 0
        UNION ALL SELECT 'rejected', '{"country": "' || country || '", "cases": ' FROM snap
        WHERE population % 7 = 0"""
    ),
    "landing_repeated_rejects": _snap(
        """SELECT '[{"continent": "' || continent || '"}, {"cases": ' AS document,
          COUNT(*) AS row_count FROM snap WHERE population % 4 = 0 GROUP BY continent
        UNION ALL SELECT '(read)', COUNT(*) FROM snap WHERE population % 4 <> 0"""
    ),
    "landing_new_files": _snap(
        f"SELECT {_list(COLUMNS)}, CAST(population % 2 AS INTEGER) AS batch FROM snap"
    ),
    "document_parse": NARROW_ROWS,
    "lake_main_parquet": ALL_ROWS,
    "lake_main_orc": ALL_ROWS,
    "lake_main_json": ALL_ROWS,
    "lake_partitioned": ALL_ROWS,
    "lake_save_modes": _snap(
        """SELECT COUNT(*) AS after_first, 2 * COUNT(*) AS after_append,
        COUNT(*) AS after_overwrite, 2 * COUNT(*) AS at_the_end,
        CAST(2 * SUM(cases) AS BIGINT) AS cases_at_the_end FROM snap"""
    ),
    "lake_overwrite_partitions": _snap(
        f"""SELECT {", ".join(f'-cases AS cases' if c == "cases" else f'"{c}"' for c in COLUMNS)}
        FROM snap WHERE continent IN ('ASIA', 'EUROPE') AND population % 2 = 0
        UNION ALL SELECT {_list(COLUMNS)} FROM snap
        WHERE continent NOT IN ('ASIA', 'EUROPE')"""
    ),
    "lake_key_lookup": _with(
        [ORDERED],
        f"""SELECT {_list(COLUMNS)}, 'country' AS search FROM ordered WHERE country = 'C100'
        UNION ALL SELECT {_list(COLUMNS)}, 'time' FROM ordered WHERE updated < 725846400000""",
    ),
    "lake_analyst_csv": ALL_ROWS,
    "lake_analyst_parquet": ALL_ROWS,
    "lake_dual_write": _snap(
        f"""SELECT 'main' AS copy, {_list(COLUMNS)},
        CAST(1717243200000 AS BIGINT) AS ingest_millis FROM snap
        UNION ALL SELECT 'analyst', {_list(COLUMNS)}, CAST(1717243200000 AS BIGINT) FROM snap"""
    ),
    "audit_columns": _snap(
        """SELECT country, updated, CAST(1717243200000 AS BIGINT) AS ingest_millis,
        '2024-06-01' AS ingest_date FROM snap"""
    ),
    "upsert_mysql_rule": _with(
        [ORDERED, SHIPPED], _merge("ordered", "shipped", NINE, NINE, COLUMNS)
    ),
    "upsert_postgres_rule": _with(
        [ORDERED, SHIPPED], _merge("ordered", "shipped", FIVE, NINE, COLUMNS)
    ),
    "upsert_all_columns": _with(
        [ORDERED, SHIPPED], _merge("ordered", "shipped", VALUES, VALUES, COLUMNS)
    ),
    "upsert_day_counters": _with(
        [ORDERED, SHIPPED, DAY_TABLES],
        _merge(
            "ordered_days",
            "shipped_days",
            FIVE,
            (*NINE, "today_cases", "today_deaths"),
            (*COLUMNS, "today_cases", "today_deaths"),
        ),
    ),
    "upsert_landed_day_counters": _with(
        [ORDERED, SHIPPED, DAY_TABLES],
        _merge(
            "ordered_days",
            "shipped_days",
            FIVE,
            (*NINE, "today_cases", "today_deaths"),
            (*COLUMNS, "today_cases", "today_deaths"),
        ),
    ),
    "upsert_latest": _with(
        [ORDERED, FEED, LATEST], _merge("ordered", "latest", NINE, NINE, COLUMNS)
    ),
    "upsert_written_batch": _with(
        [ORDERED, SHIPPED], _merge("ordered", "shipped", NINE, NINE, COLUMNS)
    ),
    "history_merge": _with(
        [ORDERED, SHIPPED], _merge("ordered", "shipped", NINE, NINE, COLUMNS)
    ),
    "bucketed_merge": _with(
        [ORDERED, SHIPPED], _merge("ordered", "shipped", NINE, NINE, COLUMNS)
    ),
    "kept_totals": _with(
        [
            ORDERED,
            SHIPPED,
            """
late AS (SELECT * FROM shipped WHERE updated >= 883612800000)""",
            f"""
merged AS ({_merge("ordered", "late", NINE, NINE, COLUMNS)})""",
        ],
        f"""SELECT continent, {SUMMARY},
        (SELECT COUNT(DISTINCT updated) FROM ordered) AS days_first,
        (SELECT COUNT(DISTINCT updated) FROM late) AS days_second,
        CAST(0 AS BIGINT) AS days_third FROM merged GROUP BY continent""",
    ),
    "assemble_features": _vectors(FEATURES),
    "assemble_strict": _vectors(STRICT_FEATURES),
    "usable_rows": _snap(
        f"SELECT country, updated, {_list(FEATURES)}, deaths AS label FROM snap WHERE {USABLE}"
    ),
    "dropped_rows": _snap(
        f"""SELECT COUNT(*) AS row_count,
        CAST(SUM(CASE WHEN {_complete(FEATURES)} THEN 0 ELSE 1 END) AS BIGINT)
          AS invalid_features,
        CAST(SUM(CASE WHEN {_complete(FEATURES)} AND deaths IS NULL THEN 1 ELSE 0 END)
          AS BIGINT) AS missing_labels FROM snap"""
    ),
    "hash_split_rows": _snap(
        f"""SELECT country, updated,
        CASE WHEN {BUCKET} < 8000 THEN 'train' ELSE 'test' END AS part FROM snap"""
    ),
    "stratified_split_rows": _with(
        [ORDERED],
        f"""SELECT country, updated, iso2, iso3, CASE WHEN rank <= FLOOR(n * 0.8E0 + 0.5E0)
          THEN 'train' ELSE 'test' END AS part
        FROM (SELECT *, COUNT(*) OVER (PARTITION BY iso2, iso3) AS n,
          ROW_NUMBER() OVER (PARTITION BY iso2, iso3 ORDER BY {PLACE}, country, updated) AS rank
          FROM ordered)""",
    ),
    "random_split_parts": _with(
        [SERIES],
        """SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS repeated, TRUE AS share_as_asked,
        TRUE AS same_on_repeat FROM series""",
    ),
    "regression_metrics": _measured(METRICS),
    "target_stats": _measured(TARGETS),
    "evaluation": _measured(f"{METRICS}, {TARGETS}"),
    "error_stats": _measured(
        """ROUND(AVG(ABS(label - prediction)), 2) AS mean_absolute_error,
        ROUND(MIN(prediction), 2) AS min_prediction,
        ROUND(MAX(prediction), 2) AS max_prediction"""
    ),
    "label_prediction_corr": _measured("ROUND(CORR(label, prediction), 6) AS corr"),
    "prediction_sample": _snap(
        """SELECT label AS actual_deaths, prediction AS predicted_deaths FROM predicted
        ORDER BY country LIMIT 10""",
        PREDICTED,
    ),
    "negative_predictions": _snap(
        "SELECT country, label, prediction FROM predicted WHERE prediction < 0", PREDICTED
    ),
    "missing_features": _snap(
        """SELECT missing, COUNT(*) AS row_count, TRUE AS named
        FROM snap, (VALUES ('tests'), ('critical'), ('deaths')) AS m(missing) GROUP BY missing"""
    ),
    "acceptance": _snap(
        """SELECT COUNT(*) AS row_count,
        SQRT(AVG((label - prediction) * (label - prediction))) <= 1000 AS at_1000,
        SQRT(AVG((label - prediction) * (label - prediction))) <= 0.1 AS at_a_tenth
        FROM predicted""",
        PREDICTED,
    ),
    "refused_formats": _snap(
        """SELECT DISTINCT continent AS format, copy, TRUE AS refused
        FROM snap, (VALUES ('main'), ('analyst')) AS c(copy)"""
    ),
    "forest_predictions": _snap(
        f"SELECT country, updated, deaths AS label, TRUE AS not_negative, {FOLLOWS} {TEST_ROWS}"
    ),
    "forest_evaluation": _snap(
        f"""SELECT COUNT(*) AS tested, CAST(SUM(deaths) AS BIGINT) AS labels, TRUE AS rmse_agrees,
        TRUE AS mae_agrees, TRUE AS r2_agrees, {FOLLOWS} {TEST_ROWS}"""
    ),
    "forest_check": _snap(
        f"""SELECT country, updated, deaths AS label, {len(FEATURES)} AS dimensions,
        TRUE AS repeatable, TRUE AS settings_as_asked, {FOLLOWS} {TEST_ROWS}"""
    ),
    "minimal_forest_check": _snap(
        f"SELECT country, updated, deaths AS label, TRUE AS settings_as_asked, {FOLLOWS} {TEST_ROWS}"
    ),
    "cross_validation_grid": f"""
SELECT num_trees, max_depth, min_instances, TRUE AS best_is_least, TRUE AS one_best,
  TRUE AS best_setting_refitted, {FOLLOWS}
FROM (VALUES (50), (100), (200)) AS t(num_trees), (VALUES (5), (10), (15)) AS d(max_depth),
  (VALUES (1), (5), (10)) AS m(min_instances)""",
    "cross_validation_check": _snap(
        f"""SELECT country, updated, deaths AS label, TRUE AS best_setting_refitted, {FOLLOWS}
        {TEST_ROWS}"""
    ),
    "cross_validation_folds": _snap(
        f"""SELECT country, updated, CAST({BUCKET.replace("% 10000", "% 3")} AS INTEGER) AS fold
        FROM snap WHERE {USABLE}"""
    ),
    "released_caches": _snap(
        f"""SELECT COUNT(*) AS tested, TRUE AS cached_while_open, 0 AS cached_after,
        0 AS tables_after {TEST_ROWS}"""
    ),
    "model_registry": _snap(
        f"SELECT country, updated, deaths AS label, TRUE AS same_prediction {TEST_ROWS}"
    ),
    "run_log": _snap(
        """SELECT 'run-1' AS run_id, 'param' AS kind, 'model_type' AS key,
          'RandomForestRegressor' AS value
        UNION ALL SELECT 'run-1', 'metric', 'total_countries', CAST(total_countries AS VARCHAR)
          FROM s
        UNION ALL SELECT 'run-1', 'metric', 'global_cases', CAST(global_cases AS VARCHAR) FROM s
        UNION ALL SELECT 'run-1', 'metric', 'global_deaths', CAST(global_deaths AS VARCHAR)
          FROM s
        UNION ALL SELECT 'run-1', 'metric', 'global_population',
          CAST(global_population AS VARCHAR) FROM s""",
        f"\ns AS (SELECT {SUMMARY} FROM snap)",
    ),
    "compacted_run_log": _snap(
        "\nUNION ALL ".join(
            f"""SELECT continent AS run_id, 'metric' AS kind, '{key}' AS key,
            CAST({key} AS VARCHAR) AS value, TRUE AS one_file FROM s"""
            for key in ("total_countries", "global_cases", "global_deaths", "global_population")
        ),
        f"\ns AS (SELECT continent, {SUMMARY} FROM snap GROUP BY continent)",
    ),
    "whole_batch": _snap(
        f"""SELECT COUNT(*) AS main_rows, CAST(SUM(cases) AS BIGINT) AS main_cases,
        COUNT(*) AS analyst_rows, CAST(SUM(cases) AS BIGINT) AS analyst_cases,
        CAST(SUM(CASE WHEN {USABLE} AND {BUCKET} >= 8000 THEN 1 ELSE 0 END) AS BIGINT)
          AS tested_rows, CAST(0 AS BIGINT) AS warnings,
        CAST({2 + 2 * len(REQUIRED) + 3} AS BIGINT) AS checks, TRUE AS default_forest FROM snap"""
    ),
}
