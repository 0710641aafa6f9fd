"""DuckDB SQL for the queries of ``lifecycle``."""

from __future__ import annotations

from starmart.plans.oracle import ORACLE as KNOWN
from starmart.plans.oracle import with_star

SCD_POINT_IN_TIME = """
WITH facts AS (
  SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_shipdate AS DATE) AS full_date, o_custkey AS student_key
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
), versions AS (
  SELECT o_custkey, o_orderkey, lower(o_orderpriority) AS health_condition, CAST(o_orderdate AS DATE) AS valid_from,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 120 END AS valid_to
  FROM orders
), last AS (
  SELECT id, v.* FROM facts JOIN versions v ON o_custkey = student_key AND valid_from <= full_date
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY valid_from DESC, o_orderkey DESC) = 1
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, full_date, student_key,
  valid_from, valid_to, o_orderkey, health_condition
FROM facts LEFT JOIN last ON last.id = facts.id AND (valid_to IS NULL OR valid_to > full_date)"""


def _measures(*names: str) -> str:
    return ",\n  ".join(
        f"CAST(SUM(CAST({m} AS DECIMAL(18,2))) AS DOUBLE) AS {m}_sum, "
        f"CAST(SUM(CAST({m} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({m}) AS {m}_avg, "
        f"MIN({m}) AS {m}_min, MAX({m}) AS {m}_max, ROUND(stddev_samp({m}), 6) AS {m}_deviation" for m in names)


INCREMENTAL = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag, l_linestatus, COUNT(*) AS n_rows,
  {_measures("l_extendedprice", "l_discount")}
FROM lineitem GROUP BY 1, 2, 3"""

STREAM_APPEND = """
WITH given AS (
  SELECT *, ts < TIMESTAMP '2024-01-20' AND event_id % 20 <> 0 AS early,
    date_trunc('week', ts) + INTERVAL 7 DAY AS closes
  FROM events
), marks AS (
  SELECT max(ts) FILTER (early) - INTERVAL 7 DAY AS first_mark, max(ts) - INTERVAL 7 DAY AS last_mark FROM given
), counted AS (
  SELECT * FROM given, marks WHERE (early OR closes > first_mark) AND closes <= last_mark
), weeks AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS n_rows,
    CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS value_sum,
    CAST(SUM(CAST(value AS DECIMAL(38,9))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS avg_value
  FROM counted GROUP BY 1, 2
)
SELECT *, coalesce(avg_value > 49.0, FALSE) AS alert FROM weeks"""

DRIFT_PSI_NUMERIC = """
WITH priced AS (
  SELECT CASE WHEN l_discount > 0 THEN l_extendedprice END AS price, l_shipdate, l_quantity FROM lineitem
), base AS (SELECT price FROM priced WHERE l_shipdate < TIMESTAMP '1998-01-01' AND l_quantity <= 40),
cur AS (SELECT price FROM priced WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
placed AS (
  SELECT price, row_number() OVER (ORDER BY price) AS place, count(*) OVER () AS n FROM base WHERE price IS NOT NULL
), bounds AS (
  SELECT list(DISTINCT price ORDER BY price) AS b FROM placed, (SELECT unnest(range(0, 11)) AS i)
  WHERE place = least(n, greatest(1, CAST(ceil(i / 10.0::DOUBLE * n) AS BIGINT)))
), binned AS (
  SELECT side, CASE WHEN price IS NULL THEN NULL WHEN price < b[1] THEN 0 WHEN price > b[len(b)] THEN greatest(2, len(b))
    ELSE greatest(1, len(list_filter(b, lambda x: x < price))) END AS bin
  FROM (SELECT 'b' AS side, price FROM base UNION ALL SELECT 'c', price FROM cur), bounds
), counts AS (
  SELECT CAST(bin AS INTEGER) AS bin, count(*) FILTER (side = 'b') AS base_count, count(*) FILTER (side = 'c') AS cur_count
  FROM binned GROUP BY 1
), shares AS (
  SELECT *, greatest(base_count / sum(base_count) OVER (), 0.0001) AS b_, greatest(cur_count / sum(cur_count) OVER (), 0.0001) AS c_ FROM counts
)
SELECT bin, base_count, cur_count, ROUND(b_, 6) AS base_share, ROUND(c_, 6) AS cur_share,
  ROUND((c_ - b_) * LN(c_ / b_), 6) AS psi_term FROM shares"""

QUARANTINE = """
WITH lines AS (
  SELECT *, o_orderkey % 50 AS kind, concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS line FROM orders
)
SELECT CASE WHEN kind IN (7, 8, 9) THEN 'line' ELSE 'row' END AS kind,
  CASE WHEN kind NOT IN (7, 8, 9) THEN o_orderkey END AS o_orderkey,
  CASE WHEN kind NOT IN (7, 8, 9) THEN o_custkey END AS o_custkey,
  CASE WHEN kind NOT IN (7, 8, 9) THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN kind NOT IN (7, 8, 9) THEN o_orderpriority END AS o_orderpriority,
  CASE kind WHEN 7 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus) WHEN 8 THEN line || ',surplus'
    WHEN 9 THEN concat(o_orderkey, ',"', concat_ws(',', o_custkey, o_orderstatus, o_orderpriority)) END AS raw_line,
  (SELECT count(*) FROM orders) AS lines_seen, (SELECT count(*) FROM orders WHERE o_orderkey % 50 IN (7, 8, 9)) AS malformed_seen
FROM lines"""


def _unique(*columns: str) -> str:
    names = ", ".join(columns)
    there = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (f"SELECT 'lineitem' AS model, '{'+'.join(columns)}' AS column_name, 'unique' AS check_name, "
            f"CAST(count(*) FILTER (n > 1) AS BIGINT) AS failures, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows "
            f"FROM (SELECT count(*) AS n FROM lineitem WHERE {there} GROUP BY {names}) g")


def _granted(role: str, rows: str, students: str) -> str:
    return (f"SELECT '{role}' AS role, severity_level, COUNT(*) AS n_rows, CAST({students} AS BIGINT) AS n_students, "
            f"CAST(SUM(CAST(trunc(bmi) AS BIGINT)) AS BIGINT) AS bmi_total FROM star WHERE {rows} GROUP BY severity_level")


def _layer_rows() -> str:
    raw = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")
    parts = [f"SELECT 'bronze' AS layer, '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in raw]
    parts.append("SELECT 'silver', 'orders', COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey")
    parts += [f"SELECT 'silver', '{t}', COUNT(*) FROM {t}" for t in ("lineitem", "part")]
    parts.append("SELECT 'gold', 'monthly', COUNT(*) FROM (SELECT DISTINCT year(l_shipdate), month(l_shipdate) FROM lineitem)")
    parts.append("SELECT 'gold', 'diets', COUNT(*) FROM (SELECT DISTINCT lower(trim(p_type)), "
                 "CASE WHEN p_size < 10 THEN 1 WHEN p_size < 30 THEN 2 ELSE 3 END FROM lineitem JOIN part ON l_partkey = p_partkey)")
    return "\nUNION ALL\n".join(parts)


ORACLE = {
    "scd_point_in_time": SCD_POINT_IN_TIME,
    "incremental_metrics": INCREMENTAL,
    "stream_append": STREAM_APPEND,
    "drift_psi_numeric": DRIFT_PSI_NUMERIC,
    "quarantine_lines": QUARANTINE,
    "unique_report": "\nUNION ALL\n".join([
        _unique("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), _unique("l_orderkey", "l_linenumber"),
        _unique("l_orderkey"), _unique("l_partkey", "l_suppkey"), _unique("l_shipdate")]),
    "role_grants": with_star("\n" + _granted("europe_analyst", "severity_level = 'europe'", "0") + "\nUNION ALL\n"
                             + _granted("everywhere", "TRUE", "COUNT(student_key)")),
    "catalog_tables": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, 'EXTERNAL' AS table_type, (SELECT COUNT(*) FROM {t}) AS row_count, "
        f"(SELECT COUNT(*) FROM {t} WHERE {cond}) AS rows_before"
        for t, cond in (("orders", "o_orderstatus = 'O'"), ("customer", "TRUE"), ("supplier", "TRUE"))),
    "layers_gate": f"SELECT 'first' AS run, TRUE AS passed, CAST(5 AS BIGINT) AS n_checks, CAST(0 AS BIGINT) AS n_failed, "
                   f"layer, table_name, row_count FROM (\n{_layer_rows()}\n) t UNION ALL "
                   f"SELECT 'second', FALSE, 5, 1, NULL, NULL, NULL",
}

KNOWN.update(ORACLE)
