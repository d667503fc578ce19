"""What the second round's findings were about: long years, and joins whose small-looking sides were sent to every task."""

import duckdb

from hexsite.functions import columns as K
from hexsite.plans import catalogue


def test_local_time_of_long_years_and_other_zones(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    ms = [0, 253402300799000 - 25200000, 253402300800000 - 25200000, 5860000000000000, -62135596801000, -1, None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(ms)], "i int, ms long")
    sql = "SELECT strftime(make_timestamp(({}::BIGINT + 25200000) * 1000), '%Y-%m-%d %H:%M:%S')"
    expected = [duckdb.execute(sql.format(v)).fetchone()[0] if v is not None else "" for v in ms]
    assert expected[1:4] == ["9999-12-31 23:59:59", "10000-01-01 00:00:00", "187666-01-03 08:46:40"]
    try:
        for other in ("UTC", "America/New_York", "Asia/Ho_Chi_Minh"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert [r.t for r in rows.select("i", K.local_time(rows.ms).alias("t")).orderBy("i").collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_iso_local_time_equals_its_sql_beyond_the_year_9999(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    duckdb.execute(f"COPY (SELECT range * 4999 AS event_id FROM range(1200)) TO '{path}' (FORMAT parquet)")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    expected = sorted(con.execute(catalogue.oracle_sql()["iso_local_time"]).fetchall())
    assert max(len(t) for _, t in expected) > 19
    assert sorted(map(tuple, catalogue.queries()["iso_local_time"](spark, str(tmp_path)).collect())) == expected


SMALL = "/root/testdata/sf0.001"


def broadcast_joins(spark, monkeypatch, name: str) -> list[str]:
    """The joins of a query, those of the tables that it stores included, of which a side would be sent to every task."""
    from hexsite.operators import graph, spatial, stats

    plans = []
    of = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for module in (graph, spatial, stats):
        monkeypatch.setattr(module, "stored", lambda df, *a, f=module.stored, **k: (plans.append(of(df)), f(df, *a, **k))[1])
    plans.append(of(catalogue.queries()[name](spark, SMALL)))
    return [line.strip() for plan in plans for line in plan.splitlines() if "BroadcastHashJoin" in line]


def test_exists_within_broadcasts_nothing(spark, monkeypatch):
    assert broadcast_joins(spark, monkeypatch, "jn10_exists_within") == []


def test_range_same_class_broadcasts_nothing(spark, monkeypatch):
    assert broadcast_joins(spark, monkeypatch, "jn9_range_same_class") == []


def test_physical_merge_broadcasts_hubs_alone(spark, monkeypatch):
    joins = broadcast_joins(spark, monkeypatch, "gr3_physical_merge")
    assert [j for j in joins if "[lo#" not in j and "[hi#" not in j] == []  # of the components, whose hubs are fewer than 1000


def test_recall_and_bias_broadcast_no_points_or_sites(spark, monkeypatch):
    for name in ("ag28_recall_bias", "ag28_bias_ratio"):
        joins = broadcast_joins(spark, monkeypatch, name)
        assert [j for j in joins if "[_p#" not in j] == []  # of the sums of partitions, a row each


def test_nearest_broadcasts_nothing(spark, monkeypatch):
    assert broadcast_joins(spark, monkeypatch, "jn11_nearest") == []


def test_nearest_meets_few_where_points_are_crowded(spark, monkeypatch):
    from hexsite.operators import spatial

    rows = [(i, 21.0 + (i * 37 % 101) / 101 * 0.009, 105.8 + (i * 53 % 103) / 103 * 0.009) for i in range(3000)]
    right = spark.createDataFrame([*rows, (5000, 21.5, 105.0), (5001, None, 105.0)], "poi int, lat double, lng double")
    left = spark.createDataFrame([*[(i, lat + 1e-5, lng) for i, lat, lng in rows[::30]], (9000, 21.5, 105.2), (9001, 0.0, 0.0), (9002, None, None)], "site int, lat double, lng double")
    met, real = [], spatial.within
    monkeypatch.setattr(spatial, "within", lambda *a, **k: met.append(real(*a, **k)) or met[-1])
    got = {r.site: (r.nearest, r.d) for r in spatial.nearest(left, "site", right, "poi", [1000.0, 4000.0, 200000.0]).selectExpr("site", "nearest", "round(dist_m, 3) AS d").collect()}
    every = real(left, right, 200000.0).selectExpr("site", "struct(dist_m, r_poi) AS b").groupBy("site").agg({"b": "min"}).toDF("site", "b")
    want = {r.site: (r.poi, r.d) for r in every.selectExpr("site", "b.r_poi AS poi", "round(b.dist_m, 3) AS d").collect()}
    assert got == want | {9001: (None, None), 9002: (None, None)} and got[9000][0] == 5000
    assert sum(df.count() for df in met) < 3001 + 40 * 100  # the far site meets all; at once within 1000 m, each of 100 meets some 2000


def test_crowded_radius(spark):
    from hexsite.operators import spatial

    df = lambda rows: spark.createDataFrame(rows, "lat double, lng double")
    assert spatial.crowded_radius(df([]), 1000.0) == spatial.crowded_radius(df([(None, 1.0), (21.0, 105.8)]), 1000.0) == 1000.0
    assert 20 < spatial.crowded_radius(df([(21.0 + i % 60 * 15e-5, 105.8 + i // 60 * 15e-5) for i in range(3600)]), 1000.0) < 60
    assert 0 < spatial.crowded_radius(df([(21.0, 105.8)] * 4000), 1000.0) < 100


def test_range_same_class_meets_its_own_class_alone(spark):
    plan = catalogue.queries()["jn9_range_same_class"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and all("_a0#" in line.split("], [")[0] for line in joins)


def test_within_of_equal_columns(spark):
    from hexsite.operators import spatial

    df = spark.createDataFrame([(1, "a", 21.0, 105.8), (2, "a", 21.001, 105.8), (3, "b", 21.0, 105.8), (4, None, 21.0, 105.8), (5, None, 21.0, 105.8)], "id int, kind string, lat double, lng double")
    got = spatial.self_pairs(df, "id", 500.0, alike=("kind",))
    assert got.columns == ["id", "kind", "lat", "lng", "r_id", "r_kind", "r_lat", "r_lng", "dist_m"]
    assert [(r.id, r.r_id) for r in got.collect()] == [(1, 2)]
