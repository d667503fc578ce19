"""Views of the benchmark tables as siting inputs. Each text runs in Spark and in the oracle alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

PROJECTIONS = {
    "sites": """
      SELECT c_custkey AS site_id, concat('C.', substr('HNISGNDNGHPGCTO', 1 + 3 * (c_nationkey % 5), 3), CAST(c_custkey AS VARCHAR(20))) AS code,
             c_nationkey AS province, CAST(c_acctbal AS DOUBLE) AS score, c_name AS name,
             20.6e0 + CAST((c_custkey * 7919) % 10007 AS DOUBLE) / 10007e0 * 0.9e0 AS lat,
             105.4e0 + CAST((c_custkey * 104729) % 10009 AS DOUBLE) / 10009e0 * 0.9e0 AS lng,
             CASE WHEN c_custkey % 11 = 0 THEN 'OUTOFSERVICE' WHEN c_custkey % 7 = 0 THEN 'INACTIVE' WHEN c_custkey % 13 = 0 THEN NULL ELSE 'ACTIVE' END AS registry_status,
             CASE WHEN c_custkey % 5 = 0 THEN 'Maintaining' WHEN c_custkey % 3 = 0 THEN 'Available' ELSE NULL END AS live_status,
             CASE WHEN c_mktsegment = 'BUILDING' THEN 'Restricted' WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Public' END AS registry_access,
             CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_custkey % 3 <> 0 END AS is_public,
             CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey % 19 <> 0 END AS is_primary,
             c_custkey % 23 <> 0 AS coord_resolved, c_custkey % 46 = 0 AS outside_admin, c_custkey % 29 = 0 AS dirty
      FROM {customer}""",
    "telemetry": """
      SELECT user_id AS station, CAST(floor(date_part('epoch', ts) / 3600e0) AS BIGINT) AS hour, event_id AS seq,
             CAST(floor(value / 50e0) AS BIGINT) AS cars, CAST(event_id % 2 AS INT) AS run
      FROM {events}""",
    "guns": """
      SELECT l_orderkey AS station, l_linenumber AS idx, CAST(p_size AS DOUBLE) * 3.5e0 AS kw,
             CASE WHEN p_size * 3.5e0 <= 25e0 THEN 'AC' ELSE 'DC' END AS current_type, CAST(l_quantity AS BIGINT) AS n,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey % 3 END AS cabinet
      FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "pixels": """
      SELECT o_orderkey AS pixel, CAST(o_totalprice AS DOUBLE) / 1000e0 AS pop,
             20.6e0 + CAST((o_orderkey * 6151) % 9973 AS DOUBLE) / 9973e0 * 0.9e0 AS lat,
             105.4e0 + CAST((o_orderkey * 3571) % 9967 AS DOUBLE) / 9967e0 * 0.9e0 AS lng, o_custkey AS owner
      FROM {orders}""",
    "poi": """
      SELECT p_partkey AS poi, CASE p_size % 7 WHEN 0 THEN 'FUEL' WHEN 1 THEN 'PARKING_OFF' WHEN 2 THEN 'MALL' WHEN 3 THEN 'SUPERMARKET' WHEN 4 THEN 'MARKET' WHEN 5 THEN 'APARTMENT' ELSE 'DEPT_STORE' END AS class,
             CASE p_partkey % 4 WHEN 0 THEN 'RESTRICTED' WHEN 1 THEN 'PUBLIC' ELSE 'UNKNOWN' END AS access, CAST(p_size AS DOUBLE) AS levels,
             20.6e0 + CAST((p_partkey * 4099) % 9949 AS DOUBLE) / 9949e0 * 0.9e0 AS lat,
             105.4e0 + CAST((p_partkey * 8191) % 9941 AS DOUBLE) / 9941e0 * 0.9e0 AS lng, p_partkey % 3 = 0 AS is_area
      FROM {part}""",
    "provinces": """
      SELECT n_nationkey AS province, n_name AS name, 20.6e0 + CAST(n_nationkey % 5 AS DOUBLE) * 0.18e0 AS lat0, 20.6e0 + CAST(n_nationkey % 5 + 1 AS DOUBLE) * 0.18e0 AS lat1,
             105.4e0 + CAST((n_nationkey - n_nationkey % 5) / 5 AS DOUBLE) * 0.18e0 AS lng0, 105.4e0 + CAST((n_nationkey - n_nationkey % 5) / 5 + 1 AS DOUBLE) * 0.18e0 AS lng1
      FROM {nation}""",
    "registry": """
      SELECT s_suppkey AS store, s_name AS name, CAST(s_acctbal AS DOUBLE) AS score, s_nationkey AS province,
             20.6e0 + CAST((s_suppkey * 7919) % 10007 AS DOUBLE) / 10007e0 * 0.9e0 + 0.0004e0 * CAST(s_suppkey % 4 AS DOUBLE) AS lat,
             105.4e0 + CAST((s_suppkey * 104729) % 10009 AS DOUBLE) / 10009e0 * 0.9e0 AS lng
      FROM {supplier}""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A projection as a DataFrame; only the columns that the query uses are read."""
    text = PROJECTIONS[name].replace("CAST(c_custkey AS VARCHAR(20))", "CAST(c_custkey AS STRING)").replace("date_part('epoch', ts)", "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    return spark.sql(text, **tables(spark, sf_dir, *dict.fromkeys(re.findall(r"\{(\w+)\}", text))))


def oracle(text: str) -> str:
    """SQL with the projections that it names put before it."""
    used = [n for n in PROJECTIONS if re.search(rf"\b{n}\b", text)]
    with_ = ",\n".join(f"{n} AS ({re.sub(r'[{}]', '', PROJECTIONS[n])})" for n in used)
    recursive = "RECURSIVE " if "/* recursive */" in text else ""
    if not used:
        return text
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {recursive}{with_},\n{body[5:]}"
    return f"WITH {recursive}{with_}\n{body}"
