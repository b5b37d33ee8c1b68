"""Independent SQL (DuckDB dialect) for every registered query that SQL can express.

The SQL restates each query from the test tables up: the stand-in raw inputs, staging, the
dimensions (dense keys as ``row_number() OVER (ORDER BY ...)``, deduplication as a
``row_number() OVER (PARTITION BY ...)`` filter), the fact and the reports. Shared steps are
named CTE blocks; ``sql(...)`` prepends the blocks a statement needs, in dependency order.
"""

from __future__ import annotations

from portstar.sources.schemas import STAGED_DEMOGRAPHICS_SCHEMA, STAGED_TRIPS_SCHEMA

ROUND = 4
_BIGINT = (-(2**53), 2**53)
_INT = (-2_147_483_648, 2_147_483_647)


def _whole(x: str, sql_type: str, bounds: tuple[int, int]) -> str:
    lo, hi = bounds
    return f"CASE WHEN {x} BETWEEN {lo} AND {hi} AND {x} = floor({x}) THEN CAST({x} AS {sql_type}) END"


def _sas_date(x: str) -> str:
    return (f"CASE WHEN {x} >= -715509 AND {x} < 2936550 "
            f"THEN CAST(DATE '1960-01-01' + CAST(floor({x}) AS INTEGER) AS DATE) END")


def _day_number(ts: str) -> str:
    return f"CAST(date_diff('day', DATE '1960-01-01', CAST({ts} AS DATE)) AS DOUBLE)"


def _week_us(d: str) -> str:
    return f"CAST(ceil(dayofyear({d} + CAST(6 - dayofweek({d}) AS INTEGER)) / 7.0) AS INTEGER)"


def _calendar(d: str) -> str:
    return (f"CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
            f"{_week_us(d)} AS week, CAST(day({d}) AS INTEGER) AS day")


TRIP_COLS = [f.name for f in STAGED_TRIPS_SCHEMA.fields]
GRAIN_COLS = [c for c in TRIP_COLS if c != "occupation"]
MEASURES = ["Median_Age", "Male_Population", "Female_Population", "Total_Population",
            "Number_of_Veterans", "Foreign_born"]
PERSON_COLS = ["cic_id", "country_code_1", "country_code_2", "birth_year", "gender"]
POPULATION_ORDER = ["State_Code", "City", "Race", "State", "Median_Age", "Male_Population",
                    "Female_Population", "Total_Population", "Number_of_Veterans",
                    "Foreign_born", "Average_Household_Size", "Count"]
FACT_COLS = (GRAIN_COLS[:5] + ["immigration_state_code"] + GRAIN_COLS[6:]
             + [f"avg_{m}" for m in MEASURES] + ["demographics_state_code", "Race", "year", "month"])


def _nulls_first(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


# name -> (dependencies, body)
BLOCKS: dict[str, tuple[list[str], str]] = {
    "arrivals": ([], f"""
    SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS DOUBLE) AS cicid,
           CAST(c.c_nationkey AS DOUBLE) AS i94cit,
           CAST(l.l_suppkey % 25 AS DOUBLE) AS i94res,
           CASE WHEN l.l_returnflag <> 'N' THEN l.l_returnflag || l.l_linestatus END AS i94port,
           {_day_number('o.o_orderdate')} AS arrdate,
           CASE WHEN c.c_nationkey <> 7 THEN lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') END AS i94addr,
           CASE WHEN l.l_linenumber % 3 <> 0 THEN {_day_number('l.l_shipdate')} END AS depdate,
           CAST(l.l_linenumber % 3 + 1 AS DOUBLE) AS i94visa,
           CASE WHEN l.l_quantity >= 49 THEN o.o_orderpriority END AS occup,
           CAST(c.c_custkey % 60 + 1940 AS DOUBLE) AS biryear,
           CASE WHEN o.o_orderstatus = 'F' THEN 'F' WHEN o.o_orderstatus = 'O' THEN 'M' END AS gender,
           substr(c.c_mktsegment, 1, 2) AS airline,
           CAST(l.l_suppkey AS VARCHAR) AS fltno
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "stage_trips": (["arrivals"], f"""
    SELECT DISTINCT
           {_whole('cicid', 'BIGINT', _BIGINT)} AS cic_id,
           CAST({_whole('i94cit', 'BIGINT', _BIGINT)} AS VARCHAR) AS country_code_1,
           CAST({_whole('i94res', 'BIGINT', _BIGINT)} AS VARCHAR) AS country_code_2,
           i94port AS city_code,
           {_sas_date('arrdate')} AS arrive_date,
           i94addr AS state_code,
           {_sas_date('depdate')} AS depart_date,
           {_whole('i94visa', 'INTEGER', _INT)} AS visa_code,
           occup AS occupation,
           {_whole('biryear', 'INTEGER', _INT)} AS birth_year,
           gender, airline, fltno AS flight_number
    FROM arrivals"""),
    "demographics": ([], """
    SELECT c.c_name AS "City", n.n_name AS "State",
           CAST(c.c_custkey % 30 + 25 AS DOUBLE) + 0.5 AS "Median Age",
           CAST(c.c_custkey % 5000 + 1000 AS INTEGER) AS "Male Population",
           CAST(floor(abs(c.c_acctbal)) + 1000 AS INTEGER) AS "Female Population",
           CAST(CAST(c.c_custkey % 5000 + 1000 AS INTEGER)
                + CAST(floor(abs(c.c_acctbal)) + 1000 AS INTEGER) AS INTEGER) AS "Total Population",
           CASE WHEN c.c_custkey % 40 <> 0 THEN CAST(c.c_custkey % 997 AS INTEGER) END AS "Number of Veterans",
           CAST(floor(abs(c.c_acctbal) / 3) AS INTEGER) AS "Foreign-born",
           CASE WHEN c.c_custkey % 45 <> 0 THEN 1.5 + CAST(c.c_custkey % 20 AS DOUBLE) / 10 END
               AS "Average Household Size",
           CASE WHEN c.c_nationkey <> 3 THEN lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') END
               AS "State Code",
           c.c_mktsegment AS "Race",
           CAST(c.c_custkey % 1000 + 1 AS INTEGER) AS "Count"
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "stage_demographics": (["demographics"], """
    SELECT DISTINCT "City" AS City, "State" AS State, "Median Age" AS Median_Age,
           "Male Population" AS Male_Population, "Female Population" AS Female_Population,
           "Total Population" AS Total_Population, "Number of Veterans" AS Number_of_Veterans,
           "Foreign-born" AS Foreign_born, "Average Household Size" AS Average_Household_Size,
           "State Code" AS State_Code, "Race" AS Race, "Count" AS Count
    FROM demographics"""),
    "by_state": (["stage_demographics"], f"""
    SELECT State_Code, {", ".join(f"AVG({m}) AS {m}" for m in MEASURES)},
           MAX(State) AS State, MAX(Race) AS Race
    FROM stage_demographics GROUP BY State_Code"""),
    "trip_grain": (["stage_trips"], f"""
    SELECT DISTINCT {", ".join(GRAIN_COLS)} FROM stage_trips"""),
    "fact": (["trip_grain", "by_state"], f"""
    SELECT {", ".join("t." + c for c in GRAIN_COLS[:5])}, t.state_code AS immigration_state_code,
           {", ".join("t." + c for c in GRAIN_COLS[6:])},
           {", ".join(f"d.{m} AS avg_{m}" for m in MEASURES)},
           d.State_Code AS demographics_state_code, d.Race,
           CAST(year(t.arrive_date) AS INTEGER) AS year, CAST(month(t.arrive_date) AS INTEGER) AS month
    FROM trip_grain t JOIN by_state d ON t.state_code = d.State_Code"""),
    "dim_person": (["stage_trips"], f"""
    SELECT {", ".join(PERSON_COLS)} FROM (
        SELECT {", ".join(PERSON_COLS)},
               row_number() OVER (PARTITION BY cic_id ORDER BY
                   {", ".join(f"{c} ASC NULLS LAST" for c in PERSON_COLS[1:])}) AS rn
        FROM stage_trips WHERE cic_id IS NOT NULL) WHERE rn = 1"""),
    "dim_airline": (["stage_trips"], f"""
    SELECT concat_ws('-', CAST(row_number() OVER (ORDER BY {_nulls_first(TRIP_COLS)}) AS VARCHAR),
                     city_code) AS travel_id,
           city_code, airline, flight_number, visa_code
    FROM stage_trips"""),
    "dim_arrive_calendar": (["stage_trips"], f"""
    SELECT arrive_date, {_calendar('arrive_date')}
    FROM (SELECT DISTINCT arrive_date FROM stage_trips WHERE arrive_date IS NOT NULL)"""),
    "dim_depart_calendar": (["stage_trips"], f"""
    SELECT depart_date, {_calendar('depart_date')}
    FROM (SELECT DISTINCT depart_date FROM stage_trips WHERE depart_date IS NOT NULL)"""),
    "dim_population": (["stage_demographics"], f"""
    SELECT row_number() OVER (ORDER BY {_nulls_first(POPULATION_ORDER)}) AS demo_pop_id,
           State, Median_Age, Male_Population, Female_Population, Total_Population,
           Foreign_born, State_Code, Race
    FROM stage_demographics"""),
}


def sql(body: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named blocks (and their dependencies, in order), then the ``extra`` CTEs,
    followed by ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in BLOCKS[name][0]:
            visit(dep)
        ordered.append(name)

    for name in needs:
        visit(name)
    bodies = [(name, BLOCKS[name][1]) for name in ordered] + list((extra or {}).items())
    if not bodies:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({text}\n)" for name, text in bodies)
    return f"WITH {ctes}\n{body.strip()}"


def _round_cols(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"round({c}, {ROUND}) AS {c}" if c in doubles else c for c in cols)


_FACT_ROUNDED = sql(f"SELECT {_round_cols(FACT_COLS, {f'avg_{m}' for m in MEASURES})} FROM fact",
                    "fact")


def _profile_long(table: str, schema) -> str:
    aggs, parts = ["count(*) AS n"], []
    for i, f in enumerate(schema.fields):
        t = f.dataType.simpleString()
        missing = f"{f.name} IS NULL" + (f" OR isnan({f.name})" if t in ("double", "float") else "")
        blank = f"{missing} OR trim({f.name}) = ''" if t == "string" else missing
        aggs.append(f"count(*) FILTER (WHERE {missing}) AS m{i}")
        aggs.append(f"count(*) FILTER (WHERE {blank}) AS b{i}")
        parts.append(f"SELECT '{f.name}' AS column_name, '{t}' AS data_type, n AS total_rows, "
                     f"m{i} AS missing_count, CAST(m{i} AS DOUBLE) * 100 / nullif(n, 0) AS missing_pct, "
                     f"b{i} AS blank_count, CAST(b{i} AS DOUBLE) * 100 / nullif(n, 0) AS blank_pct FROM agg")
    return sql(" UNION ALL ".join(parts), table,
               extra={"agg": f"SELECT {', '.join(aggs)} FROM {table}"})


def _profile_wide(table: str, schema) -> str:
    cols = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        missing = f"{f.name} IS NULL" + (f" OR isnan({f.name})" if t in ("double", "float") else "")
        cols.append(f"CAST(count(*) FILTER (WHERE {missing}) AS DOUBLE) * 100 / nullif(count(*), 0) AS {f.name}")
    return sql(f"SELECT {', '.join(cols)} FROM {table}", table)


def _key_report() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{key}' AS key_column, count(*) AS total_rows, "
        f"count(DISTINCT {key}) AS distinct_keys, count({key}) AS non_null_keys FROM {block}"
        for table, block, key in [
            ("dim_immi_personel", "dim_person", "cic_id"),
            ("dim_immi_airline", "dim_airline", "travel_id"),
            ("dim_arrive_calendar", "dim_arrive_calendar", "arrive_date"),
            ("dim_depart_calendar", "dim_depart_calendar", "depart_date"),
            ("demo_population_dim", "dim_population", "demo_pop_id"),
            ("stage_trips_by_country", "stage_trips", "country_code_1"),
            ("stage_trips_by_port", "stage_trips", "city_code"),
        ]
    ]
    body = f"""
    SELECT *, total_rows - non_null_keys AS null_keys, non_null_keys - distinct_keys AS duplicate_rows,
           CASE WHEN total_rows = non_null_keys AND non_null_keys = distinct_keys THEN 'ok'
                WHEN non_null_keys = distinct_keys THEN 'null keys'
                WHEN total_rows = non_null_keys THEN 'duplicate keys'
                ELSE 'null and duplicate keys' END AS verdict
    FROM ({" UNION ALL ".join(parts)})"""
    return sql(body, "dim_person", "dim_airline", "dim_arrive_calendar", "dim_depart_calendar",
               "dim_population", "stage_trips")


_MEASURE_COLS = [f"avg_{m}" for m in MEASURES]


def _fact_with(changes: dict[str, str], where: str, order: str) -> str:
    """The fact with some columns restated, as one version of its rows."""
    cols = [f"{changes[c]} AS {c}" if c in changes else c for c in FACT_COLS]
    return f"SELECT {', '.join(cols)}, {order} AS version FROM fact WHERE {where}"


_MOVED = "CASE WHEN cic_id % 7 = 0 THEN CAST(arrive_date - 60 AS DATE) ELSE arrive_date END"
_FIRST = "arrive_date < DATE '2000-01-01'"
_SENT = "(arrive_date >= DATE '1999-12-01' OR cic_id % 35 < 8)"
_LATER = _fact_with({}, _SENT, '1')
_WRONG = {
    'city_code': "CASE WHEN cic_id % 5 = 0 THEN 'OLD' ELSE city_code END",
    'depart_date': 'CASE WHEN cic_id % 3 <> 0 THEN depart_date END', 'arrive_date': _MOVED,
    'year': f'CAST(year({_MOVED}) AS INTEGER)', 'month': f'CAST(month({_MOVED}) AS INTEGER)'}
_CORRECTED = _fact_with({}, _FIRST + ' AND cic_id % 13 = 0', '2')
_EARLY = _CORRECTED + " UNION ALL " + _fact_with(_WRONG, _FIRST, '3')
# The first load as it was stored: its rows are chosen by the arrival day they came with.
_STORED_FIRST = _CORRECTED + " UNION ALL " + _fact_with(_WRONG, f"{_MOVED} < DATE '2000-01-01'", '3')


def _latest(rows: str) -> str:
    """One row of each traveller: the first by version, then by every other column."""
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cic_id ORDER BY version, "
            f"{_nulls_first(FACT_COLS[1:])}) AS rn FROM ({rows})) WHERE rn = 1")


_FACT_ROUND_COLS = _round_cols(FACT_COLS, set(_MEASURE_COLS))
_BOTH_LOADS = _latest(f"{_LATER} UNION ALL {_EARLY}")
_UPSERT = sql(f"SELECT {_FACT_ROUND_COLS} FROM ({_BOTH_LOADS})", "fact")


def _summary_of(rows: str, groups: str) -> str:
    return (f"SELECT {groups}, count(*) AS trips, round(avg(avg_Total_Population), {ROUND}) AS avg_population "
            f"FROM ({rows}) GROUP BY {groups}")


_AIRLINE_COLS = ["city_code", "airline", "flight_number", "visa_code"]
_CITY_COLS = "State_Code, City, Race"

_BAD_ARRIVALS = """
    SELECT * REPLACE (
        CASE WHEN CAST(cicid AS BIGINT) % 10 = 5 THEN 5e6 ELSE depdate END AS depdate,
        CASE WHEN CAST(cicid AS BIGINT) % 10 = 7 THEN cicid + 0.5 ELSE cicid END AS cicid)
    FROM arrivals"""

_NULL_ROWS = sql(" UNION ALL ".join(
    f"SELECT {', '.join(PERSON_COLS)}, '{c}' AS null_column FROM dim_person WHERE {c} IS NULL"
    for c in PERSON_COLS), "dim_person")

_DAILY = sql(f"""
    SELECT year, month, arrive_date, immigration_state_code, count(*) AS trips,
           round(avg(avg_Total_Population), {ROUND}) AS avg_population
    FROM fact GROUP BY year, month, arrive_date, immigration_state_code""", "fact")

def _dedup_sql() -> str:
    """Three deliveries one after the other: watermark before each, keys still known, rows kept."""
    deliveries = ["arrive_date < DATE '1997-01-01'",
                  "arrive_date >= DATE '1996-07-01' AND arrive_date < DATE '1998-07-01'",
                  "arrive_date >= DATE '1998-01-01' OR (arrive_date < DATE '1995-01-01' AND cic_id % 10 = 3)"]
    extra, seen, marks = {}, [], []
    for i, where in enumerate(deliveries):
        extra[f"d{i}"] = f"SELECT cic_id, arrive_date, flight_number FROM stage_trips WHERE {where}"
        before = f"greatest({', '.join(marks)})" if marks else "DATE '0001-01-01'"
        known = " UNION ALL ".join(f"SELECT cic_id FROM k{j} WHERE arrive_date >= {before}" for j in seen) or \
            "SELECT CAST(NULL AS BIGINT) WHERE FALSE"
        extra[f"k{i}"] = f"""
        SELECT cic_id, arrive_date, flight_number FROM (
          SELECT *, row_number() OVER (PARTITION BY cic_id ORDER BY arrive_date, flight_number NULLS FIRST) AS rn
          FROM d{i} WHERE arrive_date >= {before}) x
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM ({known}) s(cic_id) WHERE s.cic_id IS NOT DISTINCT FROM x.cic_id)"""
        extra[f"l{i}"] = f"SELECT * FROM d{i} WHERE arrive_date < {before}"
        marks.append(f"(SELECT coalesce(max(arrive_date) - {365}, DATE '0001-01-01') FROM d{i})")
        seen.append(i)
    body = " UNION ALL ".join([f"SELECT 'kept' AS part, * FROM k{i}" for i in seen] + [f"SELECT 'late', * FROM l{i}" for i in seen])
    return sql(body, "stage_trips", extra=extra)


ORACLE_SQL: dict[str, str] = {
    "stage_trips": sql("SELECT * FROM stage_trips", "stage_trips"),
    "stage_demographics": sql("SELECT * FROM stage_demographics", "stage_demographics"),
    "null_profile_trips": _profile_long("stage_trips", STAGED_TRIPS_SCHEMA),
    "null_profile_demographics": _profile_long("stage_demographics", STAGED_DEMOGRAPHICS_SCHEMA),
    "null_profile_wide_trips": _profile_wide("stage_trips", STAGED_TRIPS_SCHEMA),
    "drop_sparse": sql(f"SELECT {', '.join(c for c in TRIP_COLS if c != 'occupation')} FROM stage_trips",
                       "stage_trips"),
    "dim_person": sql("SELECT * FROM dim_person", "dim_person"),
    "dim_airline": sql("SELECT * FROM dim_airline", "dim_airline"),
    "dim_arrive_calendar": sql("SELECT * FROM dim_arrive_calendar", "dim_arrive_calendar"),
    "dim_depart_calendar": sql("SELECT * FROM dim_depart_calendar", "dim_depart_calendar"),
    "week_iso_calendar": sql(f"""
        SELECT arrive_date, CAST(year(arrive_date) AS INTEGER) AS year,
               {_week_us('arrive_date')} AS week_us,
               CAST(isoyear(arrive_date) AS INTEGER) AS iso_year,
               CAST(weekofyear(arrive_date) AS INTEGER) AS week_iso
        FROM (SELECT DISTINCT arrive_date FROM stage_trips WHERE arrive_date IS NOT NULL)""",
        "stage_trips"),
    "dim_population": sql("SELECT * FROM dim_population", "dim_population"),
    "demographics_by_state": sql(
        f"SELECT {_round_cols(['State_Code'] + MEASURES + ['State', 'Race'], set(MEASURES))} FROM by_state",
        "by_state"),
    "demographics_by_state_per_city": sql(f"""
        SELECT State_Code, {", ".join(f"round(AVG({m}), {ROUND}) AS {m}" for m in MEASURES)},
               MAX(State) AS State, MAX(Race) AS Race
        FROM (SELECT State_Code, City, {", ".join(f"AVG({m}) AS {m}" for m in MEASURES)},
                     MAX(State) AS State, MAX(Race) AS Race
              FROM stage_demographics GROUP BY State_Code, City)
        GROUP BY State_Code""", "stage_demographics"),
    "fact_trips": _FACT_ROUNDED,
    "fact_trips_grouped": _FACT_ROUNDED,
    "fact_unmatched_states": sql("""
        SELECT state_code, count(*) AS trips FROM trip_grain t
        WHERE NOT EXISTS (SELECT 1 FROM by_state d WHERE d.State_Code = t.state_code)
        GROUP BY state_code""", "trip_grain", "by_state"),
    "bi_population_by_state_month": sql(f"""
        SELECT year, month, immigration_state_code, count(*) AS trips,
               round(avg(avg_Total_Population), {ROUND}) AS avg_population
        FROM fact GROUP BY year, month, immigration_state_code""", "fact"),
    "bi_population_year_state": sql(f"""
        SELECT year, month, immigration_state_code, count(*) AS trips,
               round(avg(avg_Total_Population), {ROUND}) AS avg_population
        FROM fact WHERE year = 1998 AND immigration_state_code = '12'
        GROUP BY year, month, immigration_state_code""", "fact"),
    "preview_top": sql("""
        SELECT arrive_date, count(*) AS trips FROM fact GROUP BY arrive_date
        ORDER BY trips DESC, arrive_date ASC LIMIT 20""", "fact"),
    "key_report": _key_report(),
    "merge_report": sql("""
        SELECT count(*) AS trip_rows, count(t.state_code) AS trips_with_state,
               count(d.State_Code) AS fact_rows,
               count(*) FILTER (WHERE t.state_code IS NULL) AS null_state_trips,
               count(*) FILTER (WHERE t.state_code IS NOT NULL AND d.State_Code IS NULL)
                   AS unmatched_state_trips,
               CASE WHEN count(*) = count(d.State_Code) THEN 'ok'
                    ELSE 'trips dropped by the join' END AS verdict
        FROM trip_grain t LEFT JOIN (SELECT State_Code FROM by_state) d
          ON t.state_code = d.State_Code""", "trip_grain", "by_state"),
    "duplicate_cic_ids": sql("""
        SELECT cic_id, count(*) AS count FROM stage_trips GROUP BY cic_id HAVING count(*) > 1
        ORDER BY count DESC, cic_id""", "stage_trips"),
    "duplicate_dates": sql("""
        SELECT depart_date, count(*) AS count FROM stage_trips GROUP BY depart_date
        HAVING count(*) > 1 ORDER BY count DESC, depart_date""", "stage_trips"),
    "missing_dates": sql("SELECT * FROM stage_trips WHERE depart_date IS NULL", "stage_trips"),
    "null_rows_union": _NULL_ROWS,
    "null_rows_single_scan": _NULL_ROWS,
    "null_rows_one_pass": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM dim_person"
        for c in PERSON_COLS), "dim_person"),
    "null_check_verdict": sql(f"""
        SELECT '{", ".join(PERSON_COLS)}' AS checked_columns, count(*) AS checked_rows,
               count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in PERSON_COLS)}) AS rows_with_nulls,
               CASE WHEN count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in PERSON_COLS)}) = 0
                    THEN 'no nulls' ELSE 'nulls found' END AS verdict
        FROM dim_person""", "dim_person"),
    "parquet_roundtrip_partitioned": sql("SELECT * FROM stage_trips", "stage_trips"),
    "csv_roundtrip": sql("SELECT * FROM stage_demographics", "stage_demographics"),
    "csv_arrivals_roundtrip": sql("SELECT * FROM stage_trips", "stage_trips"),
    "csv_wide_arrivals": sql("SELECT * FROM stage_trips WHERE cic_id % 10 <> 6", "stage_trips"),
    "csv_rejects": sql("""
        SELECT CAST(CAST(cicid AS BIGINT) AS VARCHAR) || 'x' AS cicid, i94port, fltno, 'cicid' AS bad_columns
        FROM arrivals WHERE CAST(cicid AS BIGINT) % 10 = 6""", "arrivals"),
    "stage_rejects": sql("""
        SELECT *, CASE WHEN cicid <> floor(cicid) THEN 'cicid' ELSE 'depdate' END AS bad_columns
        FROM bad WHERE cicid <> floor(cicid) OR depdate > 2936549""", "arrivals", extra={"bad": _BAD_ARRIVALS}),
    "sas_dates_in_place": sql(f"""
        SELECT cicid, fltno, {_sas_date('arrdate')} AS arrdate, {_sas_date('depdate')} AS depdate
        FROM arrivals""", "arrivals"),
    "staging_balance": sql("""
        SELECT 'input' AS part, count(*) AS n FROM arrivals
        UNION ALL SELECT 'accepted', count(*) FROM arrivals WHERE CAST(cicid AS BIGINT) % 10 NOT IN (5, 7)
        UNION ALL SELECT 'rejected', count(*) FROM arrivals WHERE CAST(cicid AS BIGINT) % 10 IN (5, 7)
        UNION ALL SELECT 'staged', count(*) FROM stage_trips WHERE cic_id % 10 NOT IN (5, 7)""",
        "arrivals", "stage_trips"),
    "csv_malformed_lines": sql("""
        SELECT CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN k END AS cic_id,
               CASE WHEN k % 11 = 0 THEN 5 WHEN k % 13 = 0 THEN 15 ELSE 13 END AS fields,
               CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN '_corrupt_record' ELSE '' END AS bad_columns, count(*) AS n
        FROM (SELECT CAST(cicid AS BIGINT) AS k FROM arrivals) GROUP BY 1, 2, 3""", "arrivals"),
    "warehouse_build": _FACT_ROUNDED,
    "sql_quality_checks": sql(" UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS total_rows, count({key}) AS non_null_keys, "
        f"count(DISTINCT {key}) AS distinct_keys FROM {block}"
        for table, block, key in (
            ("dim_immi_personel", "dim_person", "cic_id"), ("dim_immi_airline", "dim_airline", "travel_id"),
            ("dim_arrive_calendar", "dim_arrive_calendar", "arrive_date"),
            ("dim_depart_calendar", "dim_depart_calendar", "depart_date"),
            ("demo_population_dim", "dim_population", "demo_pop_id"),
            ("stage_immigration", "stage_trips", "state_code"), ("immi_demographics", "fact", "cic_id"))),
        "dim_person", "dim_airline", "dim_arrive_calendar", "dim_depart_calendar", "dim_population",
        "stage_trips", "fact"),
    "incremental_upsert": _UPSERT,
    "snapshot_merge_on_read": _UPSERT,
    "snapshot_compacted": _UPSERT,
    "snapshot_time_travel": sql(f"SELECT {_FACT_ROUND_COLS} FROM ({_latest(_STORED_FIRST)})", "fact"),
    "snapshot_changes": sql(f"""
        SELECT change, year, month, count(*) AS n, count(DISTINCT cic_id) AS travellers FROM (
          SELECT 1 AS change, year, month, cic_id FROM ({_latest(_LATER)})
          UNION ALL SELECT -1, year, month, cic_id FROM ({_latest(_STORED_FIRST)})
            WHERE cic_id IN (SELECT cic_id FROM fact WHERE {_SENT})) GROUP BY 1, 2, 3""", "fact"),
    "summary_upkeep": sql(_summary_of(_BOTH_LOADS, "year, month, arrive_date, immigration_state_code"), "fact"),
    "summary_roll_up": sql(_summary_of(_BOTH_LOADS, "year, month, immigration_state_code"), "fact"),
    "key_registry": sql(f"""
        SELECT first.n + coalesce(k.late, 0) * (SELECT count(*) FROM first_flights) AS flight_id,
               {", ".join("k." + c for c in _AIRLINE_COLS)}, k.trips
        FROM (SELECT {", ".join(_AIRLINE_COLS)}, count(*) AS trips, CAST(NOT bool_or(
                coalesce(arrive_date < DATE '2000-01-01', FALSE)) AS INTEGER) AS late
              FROM stage_trips GROUP BY {", ".join(_AIRLINE_COLS)}) k
        JOIN (SELECT *, 0 AS late, row_number() OVER (ORDER BY {_nulls_first(_AIRLINE_COLS)}) AS n FROM first_flights
              UNION ALL SELECT *, 1, row_number() OVER (ORDER BY {_nulls_first(_AIRLINE_COLS)}) FROM (
                SELECT DISTINCT {", ".join(_AIRLINE_COLS)} FROM stage_trips EXCEPT SELECT * FROM first_flights)) first
          ON k.late = first.late AND {" AND ".join(f"k.{c} IS NOT DISTINCT FROM first.{c}" for c in _AIRLINE_COLS)}""",
        "stage_trips", extra={"first_flights": f"""
        SELECT DISTINCT {", ".join(_AIRLINE_COLS)} FROM stage_trips WHERE arrive_date < DATE '2000-01-01'"""}),
    "published_warehouse": sql(" UNION ALL ".join(
        f"SELECT 'visible' AS kind, '{t}' AS name, count(*) AS n FROM {block}" for t, block in (
            ("stage_immigration", "stage_trips"), ("stage_demographics", "stage_demographics"),
            ("dim_immi_personel", "dim_person"), ("dim_immi_airline", "dim_airline"),
            ("dim_arrive_calendar", "dim_arrive_calendar"), ("dim_depart_calendar", "dim_depart_calendar"),
            ("demo_population_dim", "dim_population"), ("immi_demographics", "fact")))
        + " UNION ALL SELECT 'finding', 'dim_arrive_calendar.arrive_date.not_null', count(*) FROM dim_arrive_calendar "
          "WHERE day = 1", "dim_person", "dim_airline", "dim_arrive_calendar", "dim_depart_calendar",
        "dim_population", "fact"),
    "schema_evolution": sql(f"""
        SELECT {_CITY_COLS}, CAST(Total_Population AS BIGINT) AS Total_Population, CAST(NULL AS INTEGER) AS Foreign_born
        FROM stage_demographics WHERE Race < 'F'
        UNION ALL SELECT {_CITY_COLS}, CAST(Total_Population AS BIGINT) * 1000000, Foreign_born
        FROM stage_demographics WHERE NOT coalesce(Race < 'F', FALSE)""", "stage_demographics"),
    "schema_refusals": sql(f"""
        SELECT {_CITY_COLS}, CAST(Total_Population AS BIGINT) * 1000000 AS Total_Population,
               'Total_Population' AS bad_columns
        FROM stage_demographics WHERE NOT coalesce(Race < 'F', FALSE)
          AND CAST(Total_Population AS BIGINT) * 1000000 NOT BETWEEN -2147483648 AND 2147483647""", "stage_demographics"),
    "key_sketch_report": sql(" UNION ALL ".join(f"""
        SELECT 'immi_demographics' AS table_name, '{k}' AS key_name, year, count(*) AS total_rows,
               count(*) - count({k}) AS null_keys, TRUE AS within_bound
        FROM fact GROUP BY year""" for k in ("cic_id", "flight_number")), "fact"),
    "column_statistics": sql(" UNION ALL ".join(f"""
        SELECT year, '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS missing,
               CAST(min({x}) AS VARCHAR) AS low, CAST(max({x}) AS VARCHAR) AS high FROM fact GROUP BY year"""
        for c, x in (("gender", "gender"), ("city_code", "city_code"), ("birth_year", "CAST(birth_year AS DOUBLE)"),
                     ("depart_date", "CAST(date_diff('day', DATE '1970-01-01', depart_date) AS DOUBLE)"))), "fact"),
    "write_status": sql(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n, TRUE AS ok FROM {block}" for t, block in (
            ("dim_immi_personel", "dim_person"), ("dim_depart_calendar", "dim_depart_calendar"),
            ("demo_population_dim", "dim_population"))), "dim_person", "dim_depart_calendar", "dim_population"),
    "preview_rows": sql("SELECT * FROM dim_arrive_calendar ORDER BY arrive_date LIMIT 20", "dim_arrive_calendar"),
    "archive_split": sql(f"""
        SELECT {_round_cols(FACT_COLS, set(_MEASURE_COLS))},
               CASE WHEN year < 1998 OR (year = 1998 AND month < 1) THEN 'archive' ELSE 'live' END AS part
        FROM fact""", "fact"),
    "bucketed_join": sql("""
        SELECT p.country_code_1 AS home_country, count(*) AS trips,
               count(DISTINCT f.cic_id) AS travellers
        FROM fact f JOIN dim_person p ON f.cic_id = p.cic_id
        GROUP BY p.country_code_1""", "fact", "dim_person"),
    "z_ordered_lookup": sql(f"""
        SELECT {_FACT_ROUND_COLS} FROM fact WHERE immigration_state_code = '12'
          AND arrive_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""", "fact"),
    "daily_summary": _DAILY,
    "event_calendar": sql(f"""
        SELECT event_date, {_calendar('event_date')}, events
        FROM (SELECT CAST(ts AS DATE) AS event_date, count(*) AS events FROM events GROUP BY 1)"""),
    "streamed_fact": _FACT_ROUNDED,
    "streamed_dedup": _dedup_sql(),
}


# Types each warehouse table is expected to have, as Spark names them (stated independently of
# the code that produces the tables).
EXPECTED_TYPES = {
    "dim_immi_airline": {"travel_id": "string", "city_code": "string", "airline": "string",
                         "flight_number": "string", "visa_code": "int"},
    "dim_arrive_calendar": {"arrive_date": "date", "year": "int", "month": "int", "week": "int",
                            "day": "int"},
    "dim_depart_calendar": {"depart_date": "date", "year": "int", "month": "int", "week": "int",
                            "day": "int"},
    "demo_population_dim": {"demo_pop_id": "bigint", "State": "string", "Median_Age": "double",
                            "Male_Population": "int", "Female_Population": "int",
                            "Total_Population": "int", "Foreign_born": "int",
                            "State_Code": "string", "Race": "string"},
    "dim_immi_personel": {"cic_id": "bigint", "country_code_1": "string",
                          "country_code_2": "string", "birth_year": "int", "gender": "string"},
    "immi_demographics": {**{c: t for c, t in zip(
        FACT_COLS,
        ["bigint", "string", "string", "string", "date", "string", "date", "int", "int",
         "string", "string", "string"] + ["double"] * 6 + ["string", "string", "int", "int"])}},
}
_TABLE_BLOCK = {"dim_immi_airline": "dim_airline", "dim_arrive_calendar": "dim_arrive_calendar",
                "dim_depart_calendar": "dim_depart_calendar", "demo_population_dim": "dim_population",
                "dim_immi_personel": "dim_person", "immi_demographics": "fact"}
_TYPE_FAMILY = {"INTEGER": ("tinyint", "smallint", "int", "bigint"), "FLOAT": ("float", "double"),
                "DATE": ("date",)}


def _contract_sql() -> str:
    from portstar.plans.contract import contract

    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"

    static, counted = [], []
    for table, rules in contract().items():
        static.append((table, None, "table_exists", "present", "present", 0))
        types = EXPECTED_TYPES[table]
        for r in rules:
            static.append((table, r.field, "column_exists", "present", "present", 0))
            actual = types[r.field]
            ok = actual == "string" if r.sql_type.startswith("VARCHAR") else actual in _TYPE_FAMILY[r.sql_type]
            static.append((table, r.field, "type", r.sql_type, actual, 0 if ok else 1))
            src = _TABLE_BLOCK[table]
            checks = []
            if r.not_null:
                checks.append(("not_null", "0 nulls", f"count(*) FILTER (WHERE {r.field} IS NULL)"))
            if r.unique:
                checks.append(("unique", "0 duplicates", f"count({r.field}) - count(DISTINCT {r.field})"))
            if r.max_length is not None and actual == "string":
                checks.append(("max_length", f"<= {r.max_length} chars",
                               f"count(*) FILTER (WHERE length({r.field}) > {r.max_length})"))
            for rule, expected, expr in checks:
                counted.append(
                    f"SELECT {lit(table)} AS table_name, {lit(r.field)} AS field, {lit(rule)} AS rule, "
                    f"{lit(expected)} AS expected, CAST({expr} AS VARCHAR) AS actual, "
                    f"CAST({expr} AS BIGINT) AS violations FROM {src}")
    values = ",\n        ".join(
        f"({lit(t)}, {lit(f)}, {lit(rule)}, {lit(e)}, {lit(a)}, CAST({v} AS BIGINT))"
        for t, f, rule, e, a, v in static)
    body = (f"SELECT * FROM (VALUES\n        {values}\n    ) AS s(table_name, field, rule, expected, actual, violations)\n"
            + "UNION ALL\n" + "\nUNION ALL\n".join(counted))
    return sql(body, *sorted(set(_TABLE_BLOCK.values())))


ORACLE_SQL["schema_contract"] = _contract_sql()
