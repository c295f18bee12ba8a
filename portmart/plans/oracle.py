"""DuckDB SQL equal to each registered query (same column names and types)."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["mart_status_by_region"] = """
WITH pairs AS (
  SELECT r.r_name, o.o_orderstatus, count(o.o_orderkey) AS cnt
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE o.o_orderstatus IN ('F', 'O')
  GROUP BY r.r_name, o.o_orderstatus
  HAVING count(o.o_orderkey) > 1000)
SELECT r_name,
       max(CASE WHEN o_orderstatus = 'F' THEN cnt END) AS "F",
       max(CASE WHEN o_orderstatus = 'O' THEN cnt END) AS "O"
FROM pairs GROUP BY r_name
"""

ORACLE_SQL["mart_priority_by_segment"] = """
WITH pairs AS (
  SELECT o.o_orderpriority, c.c_mktsegment, count(o.o_orderkey) AS cnt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
  GROUP BY o.o_orderpriority, c.c_mktsegment)
SELECT o_orderpriority,
       max(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN cnt END) AS "AUTOMOBILE",
       max(CASE WHEN c_mktsegment = 'BUILDING' THEN cnt END) AS "BUILDING"
FROM pairs GROUP BY o_orderpriority
"""

ORACLE_SQL["mart_priority_by_segment_sql"] = ORACLE_SQL["mart_priority_by_segment"]


def _title(expr: str) -> str:
    """Python str.title() in DuckDB: runs of cased letters get their first letter upper-cased
    (ß -> Ss, as Python and Spark do) and the rest lower-cased; other runs stay as they are."""
    return (r"array_to_string(list_transform(regexp_extract_all(" + expr +
            r", '([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)', 1), lambda w: CASE WHEN "
            r"regexp_matches(w, '^[\p{Lu}\p{Ll}\p{Lt}]') THEN (CASE WHEN left(w, 1) = 'ß' THEN 'Ss' "
            r"ELSE upper(left(w, 1)) END) || lower(substr(w, 2)) ELSE w END), '')")


def _iso(x: str) -> str:
    """SAS day number -> ISO text, null for null/NaN/0, floor after rounding to the microsecond."""
    whole = f"trunc({x})"
    days = f"({whole} + floor(round_even(({x} - {whole}) * 86400000000.0, 0) / 86400000000.0))"
    return (f"CASE WHEN {x} IS NOT NULL AND NOT isnan({x}) AND {x} <> 0 "
            f"THEN CAST(DATE '1960-01-01' + CAST({days} AS INTEGER) AS VARCHAR) END")


EVENTS_WITH_GAPS = """
SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
       CASE WHEN value > 10 THEN NULL WHEN value < 1 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value,
       props
FROM events"""

_PROFILE = f"""
WITH d AS ({EVENTS_WITH_GAPS}),
c AS (SELECT count(*) AS n,
             count(*) FILTER (WHERE event_id IS NULL) AS m0,
             count(*) FILTER (WHERE ts IS NULL) AS m1,
             count(*) FILTER (WHERE user_id IS NULL) AS m2,
             count(*) FILTER (WHERE event_type IS NULL) AS m3,
             count(*) FILTER (WHERE value IS NULL OR isnan(value)) AS m4,
             count(*) FILTER (WHERE props IS NULL) AS m5
      FROM d),
p AS (
  SELECT 'event_id' AS field, m0 AS nulls, n AS rows FROM c UNION ALL
  SELECT 'ts', m1, n FROM c UNION ALL
  SELECT 'user_id', m2, n FROM c UNION ALL
  SELECT 'event_type', m3, n FROM c UNION ALL
  SELECT 'value', m4, n FROM c UNION ALL
  SELECT 'props', m5, n FROM c)
SELECT field, nulls, rows, CAST(100.0 AS DOUBLE) * nulls / rows AS pct_missing
FROM p WHERE CAST(100.0 AS DOUBLE) * nulls / rows > 15.0
"""

ORACLE_SQL["sas_date_iso"] = f"""
SELECT o_orderkey, sas_day, {_iso('sas_day')} AS arrival_date
FROM (SELECT o_orderkey,
             CAST(date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) / 2.0 AS sas_day
      FROM orders)
"""

ORACLE_SQL["date_parts"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders
"""

ORACLE_SQL["title_case"] = f"SELECT doc_id, {_title('text')} AS title FROM documents"

ORACLE_SQL["label_lookup"] = """
SELECT CAST(o_custkey AS VARCHAR) AS country_code, arg_max(o_orderpriority, o_orderkey) AS country_name
FROM orders GROUP BY o_custkey
"""

ORACLE_SQL["city_lookup"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS city_code, {_title("p_name || ' ' || p_brand")} AS city_name FROM part
"""

ORACLE_SQL["state_lookup"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) || ' ' AS state_code,
       {_title("upper(s_name || ' of nation ' || CAST(s_nationkey AS VARCHAR))")} AS state_name
FROM supplier
"""

ORACLE_SQL["dedup_first"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
WHERE rn = 1
"""

ORACLE_SQL["dedup_fanout"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
             l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
             l_shipdate NULLS FIRST) AS rn
  FROM lineitem)
WHERE rn = 1
"""

ORACLE_SQL["distinct_rows"] = "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem"

ORACLE_SQL["dropna_subset_then_dedup"] = f"""
WITH d AS ({EVENTS_WITH_GAPS}),
k AS (SELECT * FROM d WHERE value IS NOT NULL AND NOT isnan(value))
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY event_id NULLS FIRST, ts NULLS FIRST, value NULLS FIRST, props NULLS FIRST) AS rn FROM k)
WHERE rn = 1
"""

ORACLE_SQL["dropna_all"] = """
SELECT status, price, priority FROM (
  SELECT nullif(o_orderstatus, 'P') AS status,
         CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS price,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END AS priority
  FROM orders)
WHERE NOT (status IS NULL AND price IS NULL AND priority IS NULL)
"""

ORACLE_SQL["null_profile"] = _PROFILE
ORACLE_SQL["null_profile_by_file"] = _PROFILE

ORACLE_SQL["filter_count"] = "SELECT count(*) AS n FROM events WHERE event_type = 'click'"

_SHAPES = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
           "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
           "conversations": 4}
ORACLE_SQL["table_shape"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS INTEGER) AS n_cols FROM {t}"
    for t, n in _SHAPES.items())

ORACLE_SQL["rename_project_drop"] = """
SELECT p_partkey AS part_id, p_brand AS brand, p_type AS part_type, p_size AS size, p_name AS part_name FROM part
"""

ORACLE_SQL["limit_ordered"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5"

ORACLE_SQL["csv_roundtrip"] = "SELECT * FROM supplier"

# Spark's CSV inference gives int for whole numbers that fit in 32 bits (every key here).
ORACLE_SQL["csv_inferred"] = """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, s_acctbal
FROM supplier
"""

ORACLE_SQL["parquet_partitioned"] = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders
"""

ORACLE_SQL["month_refresh"] = """
SELECT * FROM (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
WHERE NOT (year = 1998 AND month = 1) OR o_orderstatus = 'F'
"""

ORACLE_SQL["surrogate_key"] = """
SELECT count(*) AS n_rows, count(*) AS n_distinct_ids, CAST(0 AS BIGINT) AS n_null_ids FROM orders
"""

ORACLE_SQL["surrogate_key_dense"] = """
SELECT *, row_number() OVER (ORDER BY c_custkey) AS customer_id FROM customer
"""

ORACLE_SQL["quality_report"] = """
SELECT 'orders' AS table_name, 'schema' AS check_name, true AS passed, '' AS detail
UNION ALL SELECT 'orders', 'completeness', count(*) > 0, CAST(count(*) AS VARCHAR) || ' rows' FROM orders
UNION ALL SELECT 'customer', 'schema', false, 'c_acctbal: type double expected decimal(12,2)'
UNION ALL SELECT 'customer', 'completeness', count(*) > 0, CAST(count(*) AS VARCHAR) || ' rows' FROM customer
UNION ALL SELECT 'lineitem', 'schema', false, 'l_orderkey: nullable true expected false'
UNION ALL SELECT 'lineitem', 'completeness', count(*) > 0, CAST(count(*) AS VARCHAR) || ' rows' FROM lineitem
UNION ALL SELECT 'lineitem_relaxed', 'schema', true, ''
UNION ALL SELECT 'lineitem_relaxed', 'completeness', count(*) > 0, CAST(count(*) AS VARCHAR) || ' rows' FROM lineitem
UNION ALL SELECT 'orders_negative_price', 'completeness', count(*) > 0, CAST(count(*) AS VARCHAR) || ' rows'
          FROM orders WHERE o_totalprice < 0
"""

ORACLE_SQL["step_counts"] = f"""
WITH d AS ({EVENTS_WITH_GAPS}),
k AS (SELECT * FROM d WHERE value IS NOT NULL AND NOT isnan(value)),
n AS (SELECT (SELECT count(*) FROM d) AS n0, (SELECT count(*) FROM k) AS n1,
             (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM k)) AS n2)
SELECT 0 AS position, 'drop_missing_reading' AS step, n0 AS rows_in, n1 AS rows_out FROM n
UNION ALL SELECT 1, 'dedup_reading_key', n1, n2 FROM n
UNION ALL SELECT 2, 'drop_empty_rows', n2, n2 FROM n
"""

_ARRIVALS = """
SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
       CAST(year(o_orderdate) AS DOUBLE) AS i94yr, CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
       o_orderpriority AS i94port,
       CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
       CAST(floor(o_totalprice / 100000.0) AS DOUBLE) AS i94mode,
       o_orderstatus AS i94addr,
       CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) + o_totalprice / 10000.0 AS depdate,
       CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS i94visa,
       split_part(o_orderpriority, '-', 2) AS visatype
FROM orders"""

ORACLE_SQL["fact_build"] = f"""
SELECT cicid AS cic_id, i94yr AS year, i94mon AS month, i94port AS city_code, i94addr AS state_code,
       {_iso('arrdate')} AS arrival_date, {_iso('depdate')} AS departure_date,
       i94mode AS mode, i94visa AS visa, visatype AS visa_type
FROM ({_ARRIVALS})
"""

ORACLE_SQL["dim_build"] = """
SELECT CAST(c_custkey AS DOUBLE) AS immigration_cic_id, CAST(c_nationkey AS DOUBLE) AS country_of_birth,
       CAST(floor(c_acctbal / 1000.0) AS DOUBLE) AS country_of_residence,
       CAST(1950.0 + floor(c_acctbal / 250.0) AS DOUBLE) AS year_of_birth, c_mktsegment AS gender
FROM customer
"""

ORACLE_SQL["temperature_build"] = """
SELECT CAST(dt AS DATE) AS dt, city_name, country_name, avg_temperature, avg_temperature_delta,
       CAST(year(CAST(dt AS DATE)) AS INTEGER) AS year, CAST(month(CAST(dt AS DATE)) AS INTEGER) AS month
FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt, event_type AS city_name, 'ALL' AS country_name,
             CAST(floor(value) AS DOUBLE) AS avg_temperature, CAST(0.25 AS DOUBLE) AS avg_temperature_delta
      FROM events)
"""

_DEMOGRAPHICS = """
SELECT CAST(l_orderkey AS VARCHAR) AS city, l_returnflag AS state, l_discount AS median_age,
       CAST(floor(l_quantity) AS INTEGER) AS male_population, l_linenumber AS female_population,
       CAST(floor(l_quantity) AS INTEGER) + l_linenumber AS total_population,
       CAST(floor(l_tax * 100.0) AS INTEGER) AS number_of_veterans, CAST(l_partkey AS INTEGER) AS foreign_born_num,
       l_tax AS avg_household_size, l_linestatus AS state_code, CAST(l_linenumber AS VARCHAR) AS race,
       CAST(l_suppkey AS INTEGER) AS count
FROM lineitem"""

ORACLE_SQL["demographics_build"] = f"""
SELECT city AS city_code, state_code, median_age, male_population, female_population, total_population,
       number_of_veterans, foreign_born_num, avg_household_size, race, count FROM (
  SELECT *, row_number() OVER (PARTITION BY city, state, race
    ORDER BY median_age NULLS FIRST, male_population NULLS FIRST, female_population NULLS FIRST,
             total_population NULLS FIRST, number_of_veterans NULLS FIRST, foreign_born_num NULLS FIRST,
             avg_household_size NULLS FIRST, state_code NULLS FIRST, count NULLS FIRST) AS rn
  FROM ({_DEMOGRAPHICS}))
WHERE rn = 1
"""

ORACLE_SQL["star_lookup"] = """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus, c.c_name, cn.n_name AS cust_nation, r.r_name AS cust_region,
       s.s_name, sn.n_name AS supp_nation
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN region r ON cn.n_regionkey = r.r_regionkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
"""

ORACLE_SQL["star_preaggregated"] = """
SELECT o.o_orderkey, o.o_orderstatus, coalesce(l.n, 0) AS n_lines
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
"""

ORACLE_SQL["star_month_reading"] = """
SELECT o.o_orderkey, o.o_orderstatus, o.year, o.month, r.month_lines
FROM (SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) o
LEFT JOIN (SELECT l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
                  count(*) AS month_lines FROM lineitem GROUP BY ALL) r
  ON o.o_orderstatus = r.l_linestatus AND o.year = r.y AND o.month = r.m
"""

ORACLE_SQL["arrivals_job_state_gender"] = """
WITH a AS (
  SELECT c.c_mktsegment AS state_code,
         CASE o.o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS gender,
         CAST(o.o_orderkey AS DOUBLE) AS cic_id
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
pairs AS (
  SELECT state_code, gender, count(cic_id) AS cnt FROM a
  WHERE gender IN ('F', 'M') GROUP BY state_code, gender HAVING count(cic_id) > 1000)
SELECT state_code,
       max(CASE WHEN gender = 'F' THEN cnt END) AS "F",
       max(CASE WHEN gender = 'M' THEN cnt END) AS "M"
FROM pairs GROUP BY state_code
"""

ORACLE_SQL["arrivals_refresh"] = """
    WITH a AS (
        SELECT o_orderkey, c_mktsegment AS state_code,
               CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS gender, year(o_orderdate) AS y, month(o_orderdate) AS m
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
    k AS (SELECT * FROM a WHERE NOT (y = 1995 AND m IN (1, 2)) OR (m = 1 AND gender = 'F') OR (m = 2 AND gender = 'M'))
    SELECT state_code, count(*) AS arrivals, count(DISTINCT o_orderkey) AS ids,
           nullif(count(*) FILTER (gender = 'F'), 0) AS "F", nullif(count(*) FILTER (gender = 'M'), 0) AS "M"
    FROM k GROUP BY state_code"""

ORACLE_SQL["star_copartitioned"] = "SELECT o_orderkey, o_orderpriority, c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"


def _unique(table: str, key: str, source: str) -> str:
    whole = " AND ".join(f"{k} IS NOT NULL" for k in key.split(", "))
    return f"""
    SELECT '{table}' AS table_name, 'unique({key})' AS check_name, count(*) FILTER (n > 1) = 0 AS passed, count(*) AS keys,
           count(*) FILTER (n > 1) AS bad_keys, CAST(sum(n - 1) AS BIGINT) AS bad_rows,
           (SELECT count(*) FROM {source} WHERE NOT ({whole})) AS null_rows
    FROM (SELECT count(*) AS n FROM {source} WHERE {whole} GROUP BY {key})"""


def _refers(child: str, key: str, source: str, parent: str, parent_key: str, parent_source: str) -> str:
    return f"""
    SELECT '{child}', 'refers({key} -> {parent}.{parent_key})', count(*) FILTER (orphan) = 0, count(*), count(*) FILTER (orphan),
           CAST(coalesce(sum(n) FILTER (orphan), 0) AS BIGINT), (SELECT count(*) FROM {source} WHERE {key} IS NULL)
    FROM (SELECT {key}, count(*) AS n, {key} NOT IN (SELECT {parent_key} FROM {parent_source} WHERE {parent_key} IS NOT NULL) AS orphan
          FROM {source} WHERE {key} IS NOT NULL GROUP BY {key})"""


ORACLE_SQL["key_report"] = """
WITH nations AS (SELECT n_nationkey FROM nation UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey < 3),
customers AS (SELECT c_custkey, c_nationkey + 5 AS nation FROM customer)""" + " UNION ALL ".join([
    _unique("nation", "n_nationkey", "nations"), _unique("customer", "c_custkey", "customers"), _unique("orders", "o_orderkey", "orders"),
    _unique("lineitem", "l_orderkey, l_linenumber", "lineitem"), _refers("customer", "nation", "customers", "nation", "n_nationkey", "nations"),
    _refers("orders", "o_custkey", "orders", "customer", "c_custkey", "customers"), _refers("lineitem", "l_orderkey", "lineitem", "orders", "o_orderkey", "orders")])

ORACLE_SQL["month_publish"] = """
    WITH a AS (
        SELECT o_orderkey, c_mktsegment AS state_code,
               CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS gender, year(o_orderdate) AS y, month(o_orderdate) AS m
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
    k AS (SELECT * FROM a WHERE NOT (y = 1995 AND m = 2) OR coalesce(gender = 'M', FALSE)
          OR NOT EXISTS (SELECT 1 FROM a WHERE y = 1995 AND m = 2 AND gender = 'M'))
    SELECT state_code, count(*) AS arrivals, count(*) AS immigrants,
           nullif(count(*) FILTER (gender = 'F'), 0) AS "F", nullif(count(*) FILTER (gender = 'M'), 0) AS "M"
    FROM k GROUP BY state_code"""

ORACLE_SQL["mart_kept_visa"] = """
    WITH a AS (SELECT split_part(o_orderpriority, '-', -1) AS visa_type, o_orderstatus AS s, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
    k AS (SELECT * FROM a WHERE y <> 1994 OR s = 'F' OR NOT EXISTS (SELECT 1 FROM a b WHERE b.y = 1994 AND b.m = a.m AND b.s = 'F'))
    SELECT visa_type, nullif(count(*) FILTER (s = 'F'), 0) AS "F", nullif(count(*) FILTER (s = 'O'), 0) AS "M"
    FROM k WHERE s IN ('F', 'O') GROUP BY 1"""

ORACLE_SQL["arrivals_by_visa"] = """
    SELECT split_part(o_orderpriority, '-', -1) AS visa_type,
           nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS "F", nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS "M"
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1"""

ORACLE_SQL["star_countries"] = """
SELECT CAST(c_custkey AS DOUBLE) AS immigration_cic_id, b.n_name AS birth_country, r.n_name AS residence_country
FROM customer LEFT JOIN nation b ON c_nationkey = b.n_nationkey LEFT JOIN nation r ON floor(c_acctbal / 1000.0) = r.n_nationkey
"""

ORACLE_SQL["star_state_demographics"] = f"""
WITH c AS (
  SELECT state_code, city, max(total_population) AS t, max(foreign_born_num) AS f, max(number_of_veterans) AS v
  FROM ({_DEMOGRAPHICS}) GROUP BY ALL),
s AS (SELECT state_code, count(*) AS n_cities, CAST(sum(t) AS BIGINT) AS state_population,
             CAST(sum(f) AS BIGINT) AS state_foreign_born, CAST(sum(v) AS BIGINT) AS state_veterans
      FROM c GROUP BY state_code)
SELECT CAST(o_orderkey AS DOUBLE) AS cic_id, o_orderstatus AS state_code, n_cities, state_population, state_foreign_born,
       state_veterans
FROM orders LEFT JOIN s ON o_orderstatus = s.state_code
"""

ORACLE_SQL["star_temperature"] = """
WITH r AS (
  SELECT l_linestatus AS city, year(l_shipdate) AS y, month(l_shipdate) AS m, l_quantity, l_tax,
         row_number() OVER (PARTITION BY l_linestatus, year(l_shipdate), month(l_shipdate)
                            ORDER BY CAST(l_shipdate AS DATE), l_quantity, l_tax) AS rn
  FROM lineitem WHERE l_returnflag = 'N')
SELECT CAST(o_orderkey AS DOUBLE) AS cic_id, CAST(year(o_orderdate) AS DOUBLE) AS year,
       CAST(month(o_orderdate) AS DOUBLE) AS month, o_orderstatus AS city_code, 'City ' || o_orderstatus AS city_name,
       l_quantity AS avg_temperature, l_tax AS avg_temperature_delta
FROM orders LEFT JOIN r ON rn = 1 AND city = o_orderstatus AND y = year(o_orderdate) AND m = month(o_orderdate)
"""

ORACLE_SQL["airports_clean"] = """
SELECT DISTINCT * FROM (
  SELECT CASE WHEN p_size > 40 THEN p_brand END AS iata_code, CASE WHEN p_size > 30 THEN p_type END AS type,
         CASE WHEN p_size > 45 THEN p_size END AS elevation_ft FROM part)
WHERE iata_code IS NOT NULL OR type IS NOT NULL OR elevation_ft IS NOT NULL
"""

ORACLE_SQL["schema_listing"] = """
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type,
       true AS nullable
FROM (SELECT *, row_number() OVER (PARTITION BY column_name) AS one FROM information_schema.columns
      WHERE table_name = 'lineitem') WHERE one = 1
"""

ORACLE_SQL["demographics_job"] = ORACLE_SQL["demographics_build"]

ORACLE_SQL["temperature_job"] = """
SELECT CAST(ts AS DATE) AS dt, event_type AS city_name, 'ALL' AS country_name, CAST(min(floor(value)) AS DOUBLE) AS avg_temperature,
       CAST(0.25 AS DOUBLE) AS avg_temperature_delta, CAST(year(CAST(ts AS DATE)) AS INTEGER) AS year,
       CAST(month(CAST(ts AS DATE)) AS INTEGER) AS month
FROM events GROUP BY CAST(ts AS DATE), event_type
"""

ORACLE_SQL["labels_job"] = f"""
SELECT 'country' AS kind, CAST(c_custkey AS VARCHAR) AS code, c_mktsegment AS name FROM customer
UNION ALL SELECT 'city', CAST(p_partkey AS VARCHAR), {_title('p_name')} FROM part
UNION ALL SELECT 'state', CAST(s_suppkey AS VARCHAR), {_title('s_name')} FROM supplier
"""

ORACLE_SQL["drift_profile"] = f"""
WITH e AS ({EVENTS_WITH_GAPS}),
a AS (SELECT * FROM e WHERE event_id % 3 = 0),
b AS (SELECT * FROM e WHERE event_id % 3 = 1),
c AS (SELECT * FROM e WHERE event_id % 3 = 2),
f AS (SELECT 'event_id' AS field, 'bigint' AS type, count(*) FILTER (event_id IS NULL) AS nulls, count(*) AS rows FROM e
      UNION ALL SELECT 'user_id', 'bigint', count(*) FILTER (user_id IS NULL), count(*) FROM a
      UNION ALL SELECT 'event_type', 'string', count(*) FILTER (event_type IS NULL), count(*) FROM a
      UNION ALL SELECT 'event_type', 'string', count(*) FILTER (event_type IS NULL), count(*) FROM b
      UNION ALL SELECT 'note', 'string', count(*) FILTER (event_type IS NULL OR event_id % 2 <> 0), count(*) FROM b
      UNION ALL SELECT 'value', 'double', count(*) FILTER (value IS NULL OR isnan(value)), count(*) FROM a
      UNION ALL SELECT 'value', 'string', count(*) FILTER (value IS NULL OR NOT (value > 5)), count(*) FROM c)
SELECT field, string_agg(DISTINCT type, '|' ORDER BY type) AS types, CAST(sum(nulls) AS BIGINT) AS nulls, CAST(sum(rows) AS BIGINT) AS rows_with,
       (SELECT count(*) FROM e) AS rows, 100.0 * sum(nulls) / (SELECT count(*) FROM e) AS pct_missing
FROM f GROUP BY field
"""

ORACLE_SQL["key_registry"] = """
WITH k AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS "City", l_returnflag AS "State", CAST(l_linenumber AS VARCHAR) AS "Race" FROM lineitem)
SELECT *, row_number() OVER (ORDER BY "State" <> 'A', "City", "State", "Race") AS id FROM k
"""

ORACLE_SQL["quarantine_report"] = """
WITH e AS (SELECT event_id AS n FROM events),
r AS (SELECT n, unnest(CASE WHEN n % 97 = 0 AND n % 89 = 0 THEN ['AverageTemperature: warm', 'AverageTemperatureUncertainty: some']
                            WHEN n % 97 = 0 THEN ['AverageTemperature: warm'] WHEN n % 89 = 0 THEN ['AverageTemperatureUncertainty: some']
                            WHEN n % 101 = 0 THEN ['cells'] ELSE ['(fits)'] END) AS reason FROM e)
SELECT reason, count(*) AS records FROM r GROUP BY reason
"""

ORACLE_SQL["whole_pipeline"] = f"""
SELECT 'dim_country' AS table_name, (SELECT count(*) FROM nation) AS rows
UNION ALL SELECT 'dim_city', (SELECT count(*) FROM nation)
UNION ALL SELECT 'dim_state', (SELECT count(*) FROM region)
UNION ALL SELECT 'fact_immigration', (SELECT count(DISTINCT o_orderkey) FROM orders)
UNION ALL SELECT 'dim_immigrant_demographics', (SELECT count(DISTINCT o_orderkey) FROM orders)
UNION ALL SELECT 'dim_city_demographics', (SELECT count(*) FROM ({ORACLE_SQL["demographics_job"]}))
UNION ALL SELECT 'dim_temperature', (SELECT count(*) FROM ({ORACLE_SQL["temperature_job"]}))
"""

ORACLE_SQL["arrivals_by_state_sql"] = ORACLE_SQL["arrivals_job_state_gender"]

ORACLE_SQL["clustered_filter"] = """
SELECT 'priority' AS asked_by, count(*) AS rows, max(o_orderkey) AS last_key FROM orders WHERE o_orderpriority = '2-HIGH'
UNION ALL SELECT 'month', count(*), max(o_orderkey) FROM orders WHERE o_orderdate >= '1995-03-01' AND o_orderdate < '1995-04-01'
"""

ORACLE_SQL["arrivals_stream"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS arrivals, count(*) AS ids
FROM orders GROUP BY ALL
"""
