"""Telemetry, connectors, assets and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexsite.functions.geo import haversine_sql
from hexsite.operators import connectors as C
from hexsite.operators import spatial as X
from hexsite.operators import stats as T
from hexsite.operators import telemetry as M
from hexsite.plans.catalogue import query
from hexsite.plans.projections import oracle, tables, view


@query("jn27_merge_union", oracle("SELECT station, hour, arg_max(cars, run * 1000000000 + seq) AS cars, max(run) AS run FROM telemetry GROUP BY 1, 2"))
def merge_union(spark, sf_dir):
    return M.merge_runs(view(spark, sf_dir, "telemetry"))


PROFILE = """
WITH v AS (SELECT station, hour, seq, CASE WHEN seq % 89 = 0 THEN NULL WHEN seq % 97 = 0 THEN 'n/a' WHEN seq % 101 = 0 THEN '-2' ELSE CAST(cars AS VARCHAR) END AS cars FROM telemetry),
l AS (SELECT *, TRY_CAST(cars AS DOUBLE) AS number, hour < lag(hour) OVER (PARTITION BY station ORDER BY seq) AS back FROM v),
p AS (SELECT station, count(*) AS n, min(hour) AS t_min, max(hour) AS t_max, min(number) AS v_min, max(number) AS v_max, count_if(cars IS NULL) AS n_null,
  count_if(number < 0) AS n_negative, count_if(cars IS NOT NULL AND number IS NULL) AS n_nonnum, count(hour) - count(DISTINCT hour) AS n_repeated, count_if(back) = 0 AS monotonic FROM l GROUP BY 1)
"""


@query("ag1_series_profile", oracle(PROFILE + "SELECT * FROM p"))
def series_profile(spark, sf_dir):
    """Readings as text, some of them missing, negative or no numbers."""
    k = F.col("seq")
    text = F.when(k % 89 == 0, None).when(k % 97 == 0, "n/a").when(k % 101 == 0, "-2").otherwise(F.col("cars").cast("string"))
    return M.profile(view(spark, sf_dir, "telemetry").withColumn("cars", text))


@query("ms4_quality_flag", oracle(PROFILE + """
SELECT station, concat_ws(';', CASE WHEN n_repeated > 0 THEN 'DUP_TS' END, CASE WHEN NOT monotonic THEN 'NONMONOTONIC' END, CASE WHEN n_negative > 0 THEN 'NEG_VALUE' END,
  CASE WHEN n_nonnum > 0 THEN 'NONNUMERIC' END, CASE WHEN v_max = 0 THEN 'ALL_ZERO' END, CASE WHEN n < 24 THEN 'SPARSE' END) AS flag FROM p"""))
def quality_flag(spark, sf_dir):
    return series_profile(spark, sf_dir).select("station", M.quality_flag().alias("flag"))


DIFF = """
WITH a AS (SELECT station, hour, arg_max(cars, seq) AS cars FROM telemetry WHERE run = 0 GROUP BY 1, 2),
b AS (SELECT station, hour, arg_max(cars, seq) AS cars FROM telemetry WHERE run = 1 GROUP BY 1, 2),
sa AS (SELECT station, min(hour) AS lo, max(hour) AS hi FROM a GROUP BY 1),
sb AS (SELECT station, min(hour) AS lo, max(hour) AS hi FROM b GROUP BY 1),
w AS (SELECT coalesce(sa.station, sb.station) AS station, sa.lo IS NULL AS no_a, sb.lo IS NULL AS no_b, CASE WHEN sa.lo IS NOT NULL AND sb.lo IS NOT NULL THEN greatest(sa.lo, sb.lo) END AS lo, CASE WHEN sa.lo IS NOT NULL AND sb.lo IS NOT NULL THEN least(sa.hi, sb.hi) END AS hi FROM sa FULL JOIN sb ON sa.station = sb.station),
f AS (SELECT coalesce(a.station, b.station) AS station, coalesce(a.hour, b.hour) AS hour, a.station IS NOT NULL AS ina, b.station IS NOT NULL AS inb, a.cars IS DISTINCT FROM b.cars AS differs FROM a FULL JOIN b ON a.station = b.station AND a.hour = b.hour),
c AS (SELECT f.station, count_if(ina AND inb) AS n_common, count_if(ina AND inb AND differs) AS n_mismatch, count_if(NOT inb) AS n_only_a, count_if(NOT ina) AS n_only_b FROM f JOIN w ON f.station = w.station WHERE hour BETWEEN lo AND hi GROUP BY 1),
v AS (SELECT w.station, CASE WHEN no_a THEN 'NEW_STATION' WHEN no_b THEN 'EMPTY_SIDE' WHEN lo > hi THEN 'NO_OVERLAP' WHEN coalesce(n_mismatch, 0) > 0 THEN 'VALUE_MISMATCH'
  WHEN coalesce(n_only_a, 0) + coalesce(n_only_b, 0) > 0 THEN 'TS_SET_DIFF' ELSE 'IDENTICAL' END AS verdict,
  coalesce(n_common, 0) AS n_common, coalesce(n_mismatch, 0) AS n_mismatch, coalesce(n_only_a, 0) AS n_only_a, coalesce(n_only_b, 0) AS n_only_b FROM w LEFT JOIN c ON w.station = c.station)
"""


@query("jn26_run_diff", oracle(DIFF + "SELECT * FROM v"))
def run_diff(spark, sf_dir):
    t = view(spark, sf_dir, "telemetry")
    return M.compare_runs(M.merge_runs(t.filter("run = 0")), M.merge_runs(t.filter("run = 1")))


@query("ag31_diff_summary", oracle(DIFF + "SELECT verdict, count(*) AS n, CAST(sum(n_common) AS BIGINT) AS n_common, CAST(sum(n_mismatch) AS BIGINT) AS n_mismatch FROM v GROUP BY 1"))
def diff_summary(spark, sf_dir):
    return run_diff(spark, sf_dir).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.sum("n_common").alias("n_common"), F.sum("n_mismatch").alias("n_mismatch"))


@query("so3_top_mismatches", oracle(DIFF + "SELECT station, n_mismatch FROM v ORDER BY n_mismatch DESC, station LIMIT 25"))
def top_mismatches(spark, sf_dir):
    return run_diff(spark, sf_dir).orderBy(F.desc("n_mismatch"), "station").select("station", "n_mismatch").limit(25)


@query("ag6_witness_max", oracle("SELECT station, max(cars) AS witness FROM telemetry GROUP BY 1"))
def witness(spark, sf_dir):
    return view(spark, sf_dir, "telemetry").groupBy("station").agg(F.max("cars").alias("witness"))


@query("tw_mean_occupancy", oracle("""
WITH o AS (SELECT station, hour, avg(cars) AS v FROM telemetry GROUP BY 1, 2),
s AS (SELECT *, lead(hour) OVER w - hour AS dt, (lead(v) OVER w + v) / 2e0 AS mid FROM o WINDOW w AS (PARTITION BY station ORDER BY hour))
SELECT station, round(coalesce(sum(mid * dt) / nullif(sum(dt), 0), avg(v)), 6) AS mean FROM s GROUP BY 1"""))
def occupancy(spark, sf_dir):
    return M.time_weighted_mean(view(spark, sf_dir, "telemetry")).withColumn("mean", F.round("mean", 6))


ROLL = """
WITH r AS (SELECT station, CASE WHEN bool_or(current_type = 'AC') AND bool_or(current_type = 'DC') THEN 'MIXED' WHEN bool_or(current_type = 'AC') THEN 'AC' ELSE 'DC' END AS current_type,
  max(kw) AS max_kw, sum(kw * n) AS total_kw, CAST(sum(n) AS BIGINT) AS n_guns FROM guns GROUP BY 1)
"""


LABELS = """, d AS (SELECT DISTINCT station, current_type || '-' || regexp_replace(printf('%.3f', kw), '\\.?0+$', '') || 'kW' AS label FROM guns), b AS (SELECT station, string_agg(label, ';' ORDER BY label) AS labels FROM d GROUP BY 1)
"""


@query("ag2_rollup", oracle(ROLL + LABELS + "SELECT r.station, current_type, max_kw, round(total_kw, 4) AS total_kw, n_guns, labels FROM r JOIN b ON r.station = b.station"))
def rollup(spark, sf_dir):
    return C.rollup(view(spark, sf_dir, "guns")).withColumn("total_kw", F.round("total_kw", 4)).withColumn("labels", F.array_join("labels", ";"))


@query("jn2_attach_rollup", oracle(ROLL + "SELECT o_orderkey AS station, coalesce(n_guns, 0) AS n_guns, max_kw FROM orders LEFT JOIN r ON o_orderkey = station * 2"))
def attach(spark, sf_dir):
    stations = tables(spark, sf_dir, "orders")["orders"].select(F.col("o_orderkey").alias("station"))
    return C.attach(stations, C.rollup(view(spark, sf_dir, "guns").withColumn("station", F.col("station") * 2))).select("station", "n_guns", "max_kw")


CAB = """
WITH one AS (SELECT station, coalesce(CAST(cabinet AS VARCHAR), 'row-' || CAST(idx AS VARCHAR)) AS cab, max(kw) AS cab_kw, count(*) AS cab_n, sum(kw) AS sum_kw FROM guns GROUP BY 1, 2),
k AS (SELECT station, CAST(sum(cab_n) AS BIGINT) AS guns, max(cab_kw) AS max_kw, sum(sum_kw) AS nameplate_kw, sum(cab_kw) AS site_kw, bool_or(cab_n > 1) AS shared FROM one GROUP BY 1)
"""


@query("ag4_cabinet", oracle(CAB.replace("AS guns,", "AS n_guns,") + "SELECT station, n_guns AS n, max_kw, round(nameplate_kw, 4) AS nameplate_kw, round(site_kw, 4) AS site_kw, shared FROM k"))
def cabinet(spark, sf_dir):
    return C.cabinets(view(spark, sf_dir, "guns")).withColumnRenamed("guns", "n").withColumn("nameplate_kw", F.round("nameplate_kw", 4)).withColumn("site_kw", F.round("site_kw", 4))


STANDARDS = """
WITH reg AS (SELECT station % 500 AS code, round(kw, 1) AS kw1, station, idx, CASE idx % 3 WHEN 0 THEN 'CCS2' WHEN 1 THEN 'TYPE2' ELSE 'CHADEMO' END AS standard, CASE WHEN idx % 3 = 1 THEN 'AC' ELSE 'DC' END AS current FROM guns WHERE station % 2 = 1),
f AS (SELECT code, kw1, arg_min(standard, (station, idx)) AS standard, arg_min(current, (station, idx)) AS current FROM reg GROUP BY 1, 2),
c AS (SELECT g.station, g.idx, g.kw, coalesce(f.standard, 'UNKNOWN') AS connector_standard, coalesce(f.current, g.current_type) AS current_type, CASE WHEN f.standard IN ('CCS2', 'TYPE2') THEN 'CAR' ELSE 'UNVERIFIED' END AS vehicle_class
  FROM guns g LEFT JOIN f ON g.station % 500 = f.code AND round(g.kw, 1) = f.kw1)
"""


def _with_standards(spark, sf_dir):
    g = view(spark, sf_dir, "guns")
    i = F.col("idx") % 3
    reg = g.filter("station % 2 = 1").select((F.col("station") % 500).alias("code"), "kw", "station", "idx", F.when(i == 0, "CCS2").when(i == 1, "TYPE2").otherwise("CHADEMO").alias("standard"), F.when(i == 1, "AC").otherwise("DC").alias("current"))
    first = C.first_standard(reg, order=["station", "idx"])
    return C.with_standard(g.withColumn("code", F.col("station") % 500), first)


@query("jn4_first_wins_lookup", oracle(STANDARDS + "SELECT station, idx, connector_standard, current_type, vehicle_class FROM c"))
def first_wins(spark, sf_dir):
    """By code and power to one decimal; of the registry's, the first of each wins."""
    return _with_standards(spark, sf_dir).select("station", "idx", "connector_standard", "current_type", "vehicle_class")


@query("ag3_all_same_class", oracle(STANDARDS + "SELECT o_orderkey * 2 AS station, CASE WHEN k.n IS NULL THEN 'UNKNOWN' WHEN k.n = k.cars THEN 'CAR' ELSE 'UNVERIFIED' END AS class FROM orders LEFT JOIN (SELECT station, count(*) AS n, count_if(vehicle_class = 'CAR') AS cars FROM c GROUP BY 1) k ON o_orderkey * 2 = k.station"))
def all_same(spark, sf_dir):
    """Stations without connectors are unknown."""
    stations = tables(spark, sf_dir, "orders")["orders"].select((F.col("o_orderkey") * 2).alias("station"))
    return C.vehicle_class(stations, _with_standards(spark, sf_dir)).select("station", F.col("vehicle_class").alias("class"))


@query("json_ocpi_flatten", oracle("""
SELECT DISTINCT CAST(event_id AS VARCHAR) AS store, 'e' || e AS evse, CASE WHEN e = 0 THEN 'cab' END AS cabinet, CASE WHEN c = 0 THEN 'CCS2' ELSE 'TYPE2' END AS standard, (event_id % 90 + 10) / 1e0 AS kw, c = 0 AS is_dc
FROM events, (SELECT unnest(range(0, 2)) AS e), (SELECT unnest(range(0, 2)) AS c) WHERE e = 0 OR c = 0"""))
def ocpi(spark, sf_dir):
    """Two charge points a location, of two connectors and one; every location has a third without any."""
    e = tables(spark, sf_dir, "events")["events"].select("event_id").distinct()
    k = F.col("event_id").cast("string")
    w = ((F.col("event_id") % 90 + 10) * 1000).cast("string")
    plug = lambda n, s, t: F.concat(F.lit(f'{{"id":"{n}","standard":"{s}","power_type":"{t}","max_electric_power":'), w, F.lit("}"))
    payload = F.concat(
        F.lit('{"id":"'), k, F.lit('","evses":[{"uid":"e0","physical_reference":"cab","status":"AVAILABLE","connectors":['), plug(1, "CCS2", "DC"), F.lit(","), plug(2, "TYPE2", "AC_3_PHASE"),
        F.lit(']},{"uid":"e1","status":"X","connectors":['), plug(1, "CCS2", "DC"), F.lit(']},{"uid":"e2","connectors":[]}]}'),
    )
    return C.flattened(e.select(payload.alias("p")), "p").select("store", "evse", "cabinet", "standard", "kw", "is_dc")


ASSETS = CAB.replace("AS guns,", "AS reg_guns,") + """,
l AS (SELECT o_orderkey AS station, o_custkey AS owner, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 9 END AS live_guns, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 9 AS DOUBLE) * 11e0 END AS live_total_kw FROM orders),
t AS (SELECT station, max(cars) AS witness FROM telemetry GROUP BY 1),
j AS (SELECT l.station, reg_guns, live_guns, live_total_kw, witness, nameplate_kw, site_kw, shared FROM l LEFT JOIN (SELECT * FROM k WHERE station % 4 = 1) k ON l.station = k.station LEFT JOIN t ON l.station = t.station),
a AS (SELECT *, CASE WHEN reg_guns IS NOT NULL THEN 'OFFICIAL' WHEN coalesce(live_guns, 0) > 0 THEN 'EVCS_LIVE' WHEN coalesce(witness, 0) > 0 THEN 'TELEMETRY_BOUND' ELSE 'UNKNOWN' END AS config_src FROM j)
"""


def _assets(spark, sf_dir):
    o = tables(spark, sf_dir, "orders")["orders"]
    third = F.col("o_orderkey") % 3 == 0
    live = o.select(F.col("o_orderkey").alias("station"), F.when(~third, F.col("o_orderkey") % 9).alias("live_guns"), F.when(~third, (F.col("o_orderkey") % 9).cast("double") * 11.0).alias("live_total_kw"))
    reg = C.cabinets(view(spark, sf_dir, "guns")).filter("station % 4 = 1").select("station", F.col("guns").alias("reg_guns"), F.col("nameplate_kw").alias("reg_nameplate_kw"), F.col("site_kw").alias("reg_site_kw"), F.col("shared").alias("reg_shared"))
    return C.resolve_assets(live.join(reg, "station", "left").join(witness(spark, sf_dir), "station", "left"))


@query("ms13_asset_layer", oracle(ASSETS + """
SELECT station, config_src, config_src IN ('OFFICIAL', 'EVCS_LIVE') AS config_resolved,
  CASE WHEN config_src <> 'UNKNOWN' THEN greatest(coalesce(reg_guns, 0), coalesce(live_guns, 0), coalesce(witness, 0)) END AS n_guns_installed,
  round(CASE WHEN config_src <> 'UNKNOWN' THEN coalesce(nameplate_kw, live_total_kw) END, 4) AS nameplate_kw,
  round(CASE WHEN config_src <> 'UNKNOWN' THEN coalesce(site_kw, nameplate_kw, live_total_kw) END, 4) AS site_kw,
  concat_ws(';', CASE WHEN reg_guns > coalesce(live_guns, 0) THEN 'TRUNCATED' END, CASE WHEN config_src = 'UNKNOWN' THEN 'UNKNOWN' END, CASE WHEN config_src = 'TELEMETRY_BOUND' THEN 'LOWER_BOUND' END, CASE WHEN shared THEN 'CABINET' END) AS flags
FROM a"""))
def asset_layer(spark, sf_dir):
    return _assets(spark, sf_dir).select("station", "config_src", "config_resolved", "n_guns_installed", F.round("nameplate_kw", 4).alias("nameplate_kw"), F.round("site_kw", 4).alias("site_kw"), F.array_join("flags", ";").alias("flags"))


@query("ag7_impute", oracle("""
WITH s AS (SELECT site_id, province, registry_status, CASE WHEN site_id % 6 = 0 THEN NULL ELSE score END AS v FROM sites),
m1 AS (SELECT province, registry_status, quantile_cont(v, 0.5) AS m FROM s WHERE v IS NOT NULL GROUP BY 1, 2),
m2 AS (SELECT province, quantile_cont(v, 0.5) AS m FROM s WHERE v IS NOT NULL GROUP BY 1)
SELECT site_id, round(coalesce(v, round_even(greatest(coalesce(m1.m, m2.m, (SELECT quantile_cont(v, 0.5) FROM s)), 1e0), 0)), 4) AS imputed
FROM s LEFT JOIN m1 ON s.province = m1.province AND s.registry_status = m1.registry_status LEFT JOIN m2 ON s.province = m2.province"""))
def impute(spark, sf_dir):
    s = view(spark, sf_dir, "sites").select("site_id", "province", "registry_status", F.when(F.col("site_id") % 6 != 0, F.col("score")).alias("v"))
    return C.impute_median(s, value="v", levels=[["province", "registry_status"], ["province"], []]).select("site_id", F.round("imputed", 4).alias("imputed"))


@query("ag8_robust_centroids", oracle("SELECT province, round(quantile_cont(lat, 0.5), 6) AS lat, round(quantile_cont(lng, 0.5), 6) AS lng, count(*) AS n FROM sites WHERE province IS NOT NULL GROUP BY 1 HAVING count(*) >= 20"))
def centroids(spark, sf_dir):
    g = view(spark, sf_dir, "sites").filter("province IS NOT NULL").groupBy("province").agg(F.percentile("lat", 0.5).alias("lat"), F.percentile("lng", 0.5).alias("lng"), F.count(F.lit(1)).alias("n"))
    return g.filter("n >= 20").select("province", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "n")


@query("ag10_crosswalk", oracle("""
WITH c AS (SELECT province, coalesce(registry_access, 'none') AS label, count(*) AS c FROM sites GROUP BY 1, 2),
m AS (SELECT province, arg_min(label, (-c, label)) AS label, max(c) AS n_mode, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY 1)
SELECT province, CASE WHEN n >= 20 AND n_mode * 1e0 / n >= 0.6e0 THEN label END AS label, n, CASE WHEN n < 20 THEN 'TOO_FEW' WHEN n_mode * 1e0 / n >= 0.6e0 THEN 'OK' ELSE 'AMBIGUOUS' END AS status FROM m"""))
def crosswalk(spark, sf_dir):
    s = view(spark, sf_dir, "sites").withColumn("label", F.coalesce("registry_access", F.lit("none")))
    return T.crosswalk(s, "province", "label", least=20, purity=0.6).select("province", "label", "n", "status")


@query("ag27_spearman", oracle("""
WITH r AS (SELECT rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2e0 AS rx, rank() OVER (ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2e0 AS ry FROM orders)
SELECT round(corr(rx, ry), 9) AS rho, count(*) AS n FROM r"""))
def spearman(spark, sf_dir):
    return T.spearman(tables(spark, sf_dir, "orders")["orders"], "o_totalprice", "o_custkey").withColumn("rho", F.round("rho", 9))


THIRDS = """
WITH r AS (SELECT site_id, score, row_number() OVER (ORDER BY coalesce(score, 0), site_id) AS k, count(*) OVER () AS n FROM sites),
t AS (SELECT site_id, CASE WHEN 3 * (k - 1) < n - 1 THEN 'low' WHEN 3 * (k - 1) < 2 * (n - 1) THEN 'mid' ELSE 'high' END AS stratum FROM r)
"""


@query("wn12_terciles", oracle(THIRDS + "SELECT site_id, stratum FROM t"))
def terciles(spark, sf_dir):
    """Thirds of the rank over all sites."""
    return T.strata(view(spark, sf_dir, "sites").select("site_id", "score"), "site_id", "score")


HITS = THIRDS + f""", h AS (SELECT a.site_id, coalesce(min({haversine_sql("a.lat", "a.lng", "b.lat", "b.lng")}) <= 300e0, false) AS h300, coalesce(min({haversine_sql("a.lat", "a.lng", "b.lat", "b.lng")}) <= 900e0, false) AS h900 FROM sites a, poi b GROUP BY 1),
j AS (SELECT t.site_id, stratum, CAST(coalesce(h300, false) AS INT) AS h300, CAST(coalesce(h900, false) AS INT) AS h900 FROM t LEFT JOIN h ON t.site_id = h.site_id),
q AS (SELECT stratum, count(*) AS n, avg(h300) AS r300, avg(h900) AS r900 FROM j GROUP BY 1 UNION ALL SELECT 'ALL', count(*), avg(h300), avg(h900) FROM j)
"""


def _recall(spark, sf_dir):
    s = view(spark, sf_dir, "sites").select("site_id", "score", "lat", "lng")
    hit = X.exists_within(s.select("site_id", "lat", "lng"), "site_id", view(spark, sf_dir, "poi").select("poi", "lat", "lng"), [300.0, 900.0])
    return T.recall(hit.join(T.strata(s, "site_id", "score").hint("merge"), "site_id"), "site_id", {300: "within_300", 900: "within_900"})


@query("ag28_recall_bias", oracle(HITS + "SELECT stratum, n, round(r300, 6) AS recall_300, round(r900, 6) AS recall_900 FROM q"))
def recall(spark, sf_dir):
    """Share of sites with a point of interest within each radius, by thirds of score."""
    return _recall(spark, sf_dir).select("stratum", "n", F.round("recall_300", 6).alias("recall_300"), F.round("recall_900", 6).alias("recall_900"))


@query("ag28_bias_ratio", oracle(HITS + "SELECT round((SELECT r900 FROM q WHERE stratum = 'high') / nullif((SELECT r900 FROM q WHERE stratum = 'low'), 0), 6) AS ratio"))
def bias(spark, sf_dir):
    return T.bias(_recall(spark, sf_dir), 900).select(F.round("ratio", 6).alias("ratio"))


@query("wn14_quantile_filter", oracle("SELECT o_orderkey AS k FROM orders WHERE o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.9) FROM orders)"))
def quantile_filter(spark, sf_dir):
    return T.above_quantile(tables(spark, sf_dir, "orders")["orders"].select(F.col("o_orderkey").alias("k"), "o_totalprice"), "o_totalprice", 0.9).select("k")


@query("ag26_ratio_stats", oracle("SELECT round(min(l_extendedprice / l_quantity), 6) AS r_min, round(max(l_extendedprice / l_quantity), 6) AS r_max, round(avg(l_extendedprice / l_quantity), 5) AS r_mean, round(stddev_pop(l_extendedprice / l_quantity), 5) AS r_std FROM lineitem"))
def ratios(spark, sf_dir):
    r = T.ratio_stats(tables(spark, sf_dir, "lineitem")["lineitem"], "l_extendedprice", "l_quantity")
    return r.select(F.round("r_min", 6).alias("r_min"), F.round("r_max", 6).alias("r_max"), F.round("r_mean", 5).alias("r_mean"), F.round("r_std", 5).alias("r_std"))


@query("wn11_freshness", oracle("SELECT station, round_even((max(max(hour)) OVER () - max(hour)) / 24e0, 2) AS days FROM telemetry GROUP BY 1"))
def freshness(spark, sf_dir):
    t = view(spark, sf_dir, "telemetry").groupBy("station").agg(F.max("hour").alias("last"))
    newest = t.agg(F.max("last").alias("newest"))
    return t.crossJoin(F.broadcast(newest)).select("station", F.bround((F.col("newest") - F.col("last")) / 24, 2).alias("days"))  # one row is broadcast
