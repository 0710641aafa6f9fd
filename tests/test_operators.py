"""Operator tests: paging, star join, SCD, trends, merge, masking, drift, stream."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.operators import incremental, masking, paging, quality, scd, star, trends
from starmart.operators.checks import relationship_failures, unique_failures
from tests.conftest import rows


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))


def test_page_bounds(numbers):
    for limit, offset in ((0, 0), (501, 0), (10, -1)):
        with pytest.raises(ValueError):
            paging.page(numbers, ["k"], limit, offset)


def test_page_deep_and_keyset_agree(spark, numbers):
    shallow = [r.k for r in paging.page(numbers, ["k"], 50, 1500).collect()]
    assert shallow == list(range(1500, 1550))
    deep = [r.k for r in paging.page_deep(numbers, ["k"], 50, 1500).collect()]
    assert deep == shallow
    after = [r.k for r in paging.page(numbers, ["k"], 5, 0, after=[1499]).collect()]
    assert after == list(range(1500, 1505))
    tail = [r.k for r in paging.page(numbers, ["k"], 50, 1990).collect()]
    assert tail == list(range(1990, 2000))


def test_pages_put_nulls_last(spark):
    df = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "k long")
    want = [18, 19, None]
    assert [r.k for r in paging.page(df, ["k"], 3, 18).collect()] == want
    assert [r.k for r in paging.page_deep(df, ["k"], 3, 18).collect()] == want
    assert [r.k for r in paging.page(df, ["k"], 3, 0, after=[17]).collect()] == want


def test_no_task_gathers_the_rows_before_a_page(spark):
    df = spark.range(0, 30_000).select(F.when(F.col("id") < 29_990, F.col("id")).alias("k"), F.col("id").alias("j")).repartition(5)
    for offset in (0, 100, 20_000, 29_980, 40_000):
        got = paging.page(df, ["k", "j"], 20, offset)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("TakeOrdered", "GlobalLimit", "CollectLimit")), plan
        assert [r.j for r in got.collect()] == list(range(30_000))[offset : offset + 20]


def test_falsy_filters_are_ignored(numbers):
    assert paging.apply_filters(numbers, {"g": 0}).count() == 2000
    assert paging.apply_filters(numbers, {"g": 3}).count() == numbers.where("g = 3").count()
    with pytest.raises(ValueError):
        paging.lookup(numbers, {"k": 0})
    assert paging.lookup(numbers, {"k": 5000}).count() == 0


def test_star_join_drops_orphans_and_checks_broadcast(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "f long, d long")
    dim = spark.createDataFrame([(10, "a"), (20, "b")], "d long, name string")
    out = star.star_join(fact, [star.Dim(dim, "d", "d", ["name"], broadcast_max_rows=5)])
    assert rows(out, "f", "name") == [(1, "a"), (2, "b")]
    assert star.row_count_at_most(dim, 2) and not star.row_count_at_most(dim, 1)
    assert relationship_failures(fact, dim, "d", "d").count() == 1


def test_skewed_key_join_is_whole(spark):
    # one key holds half of the fact rows; the join must keep every row
    fact = spark.range(0, 20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 100).alias("d"))
    dim = spark.range(0, 100).select(F.col("id").alias("d"), F.lit("x").alias("v"))
    out = star.star_join(fact, [star.Dim(dim, "d", "d", ["v"])])
    assert out.count() == 20000


def test_scd_latest_and_as_of(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), 1, "a"), (1, dt.date(2021, 1, 1), 2, "b"),
         (1, dt.date(2021, 1, 1), 3, "c"), (2, dt.date(2019, 6, 1), 4, "d")],
        "k long, start date, v long, label string")
    assert rows(scd.latest(df, ["k"], ["start", "v"]), "k", "label") == [(1, "c"), (2, "d")]
    assert rows(scd.as_of(df, ["k"], "start", "2020-06-01", ["v"]), "k", "label") == \
        [(1, "a"), (2, "d")]
    hist = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2021, 1, 1)),
                                  (1, dt.date(2021, 1, 1), None)], "k long, s date, e date")
    assert rows(scd.valid_at(hist, "2021-01-01", "s", "e"), "s") == [(dt.date(2021, 1, 1),)]


def test_weekly_trend_and_trajectory(spark):
    ts = [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 3, 10), dt.datetime(2024, 1, 9),
          dt.datetime(2024, 1, 16)]
    df = spark.createDataFrame([(1, t, v) for t, v in zip(ts, [1.0, 3.0, 5.0, 5.2])],
                               "u long, ts timestamp_ntz, v double")
    weekly = trends.weekly_means(df, "u", "ts", "v")
    tr = trends.trend_direction(weekly, "u", tolerance=0.5)
    assert rows(tr, "week_start", "avg_value", "direction") == [
        (dt.date(2024, 1, 1), 2.0, None), (dt.date(2024, 1, 8), 5.0, "up"),
        (dt.date(2024, 1, 15), 5.2, "flat")]
    traj = trends.trajectory(df, "u", "ts", "v")
    assert [r.running_avg for r in traj.orderBy("day").collect()] == [1.0, 2.0, 3.0, 3.55]


def test_merge_upserts_latest_version(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, ver long")
    batch = spark.createDataFrame([(2, "b2", 2), (2, "b3", 3), (3, "c", 1)],
                                  "k long, v string, ver long")
    out = incremental.merge(target, batch, ["k"], ["ver"])
    assert rows(out, "k", "v") == [(1, "a"), (2, "b3"), (3, "c")]


def test_role_view_masks_and_filters(spark):
    df = spark.createDataFrame([(1, "x1", "eu"), (2, "x2", "us")], "k long, pid string, r string")
    pol = {"analyst": masking.RolePolicy(columns={"pid": "hash", "k": "drop"},
                                         row_filter="r = 'eu'", salt="s")}
    out = masking.role_view(df, pol, "analyst")
    assert out.columns == ["pid", "r"] and out.count() == 1
    assert len(out.first().pid) == 64
    with pytest.raises(PermissionError):
        masking.role_view(df, pol, "guest")


def test_psi_is_zero_for_same_distribution(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    out = quality.psi(df, df, "c")
    assert out.count() == 3
    assert out.agg(F.sum("psi_term")).first()[0] == 0.0


def test_unique_failures_ignore_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert rows(unique_failures(df, "k")) == [(1, 2)]


def test_weekly_stream_matches_batch(spark, tmp_path):
    from starmart.specs import DRIVER_SCHEMAS
    from starmart.streaming.weekly import run_weekly_stream
    src = "/root/testdata/sf0.001/events.parque[t]"
    out = str(tmp_path / "out")
    run_weekly_stream(spark, src, DRIVER_SCHEMAS["events"], "ts", ["event_type"], "value", out,
                      checkpoint=str(tmp_path / "ckpt"), alert_path=str(tmp_path / "alerts"),
                      alert_above=0.0)
    got = spark.read.parquet(out)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert got.agg(F.sum("n_rows")).first()[0] == ev.count()
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == got.count()


def test_catalog_layers(spark, tmp_path):
    from starmart.sources.layers import (layer_summary, list_tables, register_layer,
                                         write_layer)
    root = str(tmp_path / "lake")
    df = spark.range(5).select(F.col("id").alias("k"), (F.col("id") > 2).alias("flag"))
    write_layer(df, root, "marts", "t1", bool_as_int=True)
    write_layer(df, root, "marts", "t2", partition_by=["flag"])
    assert rows(layer_summary(spark, root, "marts", ["t1", "t2", "missing"])) == \
        [("t1", 5), ("t2", 5)]
    assert register_layer(spark, root, "marts", ["t1", "t2"]) == ["marts.t1", "marts.t2"]
    assert spark.table("marts.t1").count() == 5
    assert dict(spark.table("marts.t1").dtypes)["flag"] == "int"
    listed = [(r.database, r.table_name) for r in list_tables(spark, ["marts"]).collect()]
    assert listed == [("marts", "t1"), ("marts", "t2")]


def test_failed_write_keeps_previous_table(spark, tmp_path):
    from starmart.sources.layers import read_layer, write_layer
    root = str(tmp_path / "lake")
    write_layer(spark.range(3), root, "marts", "t")
    bad = spark.range(3).select((F.lit(1) / F.col("id")).alias("id"))  # ANSI: 1/0 raises
    with pytest.raises(Exception):
        write_layer(bad, root, "marts", "t")
    assert rows(read_layer(spark, root, "marts", "t")) == [(0,), (1,), (2,)]
    write_layer(spark.range(5), root, "marts", "t")
    assert read_layer(spark, root, "marts", "t").count() == 5


def test_bucketed_tables_join_without_shuffle(spark):
    from starmart.sources.layers import write_bucketed
    fact = spark.range(0, 5000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    dim = spark.range(0, 500).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    write_bucketed(fact, "bucket_test", "fact", 4, ["k"])
    write_bucketed(dim, "bucket_test", "dim", 4, ["k"])
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.star_join(spark.table("bucket_test.fact"),
                                [star.Dim(spark.table("bucket_test.dim"), "k", "k", ["name"])])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_salted_join_equals_plain_join(spark):
    fact = spark.range(0, 30000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("d"))
    dim = spark.range(0, 500).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    assert star.hot_keys(fact, ["d"], 0.05) == [(7,)]
    plain = star.star_join(fact, [star.Dim(dim, "d", "d", ["v"])])
    salted = star.star_join(fact, [star.Dim(dim, "d", "d", ["v"], skew_buckets=8,
                                            hot_fraction=0.05, name="dd")])
    assert salted.columns == plain.columns
    assert sorted(salted.collect()) == sorted(plain.collect())


def test_weekly_stream_ignores_session_time_zone(spark, tmp_path):
    from starmart.specs import DRIVER_SCHEMAS
    from starmart.streaming.weekly import run_weekly_stream
    src = "/root/testdata/sf0.001/events.parque[t]"
    got = {}
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out = str(tmp_path / f"out-{tz.replace('/', '_')}")
            run_weekly_stream(spark, src, DRIVER_SCHEMAS["events"], "ts", ["event_type"],
                              "value", out, checkpoint=str(tmp_path / f"ckpt-{len(got)}"))
            got[tz] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got["UTC"] == got["America/New_York"]
    batch = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy(
        F.date_trunc("week", "ts").cast("date").alias("w"), "event_type").count()
    assert sorted((r.w, r.event_type, r["count"]) for r in batch.collect()) == \
        sorted((r[0], r[1], r[2]) for r in got["UTC"])


def test_derive_validity_matches_per_key_lead_with_hot_key(spark):
    from pyspark.sql import Window
    rows_ = [(0 if i % 3 else i % 17, dt.date(2020, 1, 1) + dt.timedelta(days=i % 400), i)
             for i in range(3000)]  # key 0 holds two thirds of the rows
    df = spark.createDataFrame(rows_, "k long, s date, v long")
    got = scd.derive_validity(df, ["k"], "s", ["v"], partitions=7)
    want = df.withColumn("valid_to", F.lead("s").over(Window.partitionBy("k").orderBy("s", "v")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_partitioned_stage_prunes_folders(spark, tmp_path):
    from starmart.plans import driver as D
    from starmart.sources.layers import read_layer, write_layer
    root = str(tmp_path / "lake")
    staged = D.stage_fact(D.read(spark, "/root/testdata/sf0.001", "lineitem"))
    write_layer(staged, root, "staging", "lineitem", partition_by=("year", "month"))
    back = read_layer(spark, root, "staging", "lineitem")
    assert back.count() == staged.count()
    one = back.where((F.col("year") == 1995) & (F.col("month") == 3))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan
    assert one.count() == staged.where((F.col("year") == 1995) & (F.col("month") == 3)).count()


def test_weekly_stream_append_drops_late_rows_and_emits_once(spark, tmp_path):
    from starmart.specs import DRIVER_SCHEMAS
    from starmart.streaming.weekly import run_weekly_stream
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    split = F.lit("2024-01-22").cast("timestamp_ntz")

    def drain():
        run_weekly_stream(spark, src, DRIVER_SCHEMAS["events"], "ts", ["event_type"], "value",
                          out, checkpoint=ckpt, mode="append")

    ev.where(F.col("ts") < split).coalesce(1).write.parquet(src)
    drain()
    # Second file: the rest of the month plus copies of week-one rows that
    # arrive after the watermark (max event time - 7 days) has passed them.
    late = ev.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")) \
        .withColumn("value", F.col("value") + F.lit(1000.0))
    ev.where(F.col("ts") >= split).unionByName(late).coalesce(1) \
        .write.mode("append").parquet(src)
    drain()

    got = spark.read.parquet(out)
    assert got.groupBy("week_start", "event_type").count().where("count > 1").count() == 0
    on_time = ev.groupBy(F.date_trunc("week", "ts").cast("date").alias("week_start"),
                         "event_type").agg(F.count(F.lit(1)).alias("n_rows"))
    emitted = sorted((r.week_start, r.event_type, r.n_rows)
                     for r in got.select("week_start", "event_type", "n_rows").collect())
    want = {(r.week_start, r.event_type): r.n_rows for r in on_time.collect()}
    assert emitted and all(want[(w, e)] == n for w, e, n in emitted)
    assert {w for w, _, _ in emitted} >= {dt.date(2024, 1, 1), dt.date(2024, 1, 8)}
    assert got.where(F.col("avg_value") > 500).count() == 0  # late copies never counted


def brute_page(rows_, limit, offset):
    """Python's order with NULLs last, then the slice."""
    ordered = sorted(rows_, key=lambda r: tuple(x for v in r for x in (v is None, 0 if v is None else v)))
    return ordered[offset:offset + limit]


@pytest.mark.parametrize("kind", ["unique", "hot", "nulls", "text", "equal"])
def test_every_page_by_key_ranges(spark, kind):
    import random
    rng = random.Random(4)
    n = 400
    data = {
        "unique": [(i, 0) for i in range(n)],
        # one key holds most rows and is divided by the next key; so is its neighbour
        "hot": [(rng.choice([5, 5, 5, 5, 6, 6, rng.randrange(30)]), i) for i in range(n)],
        "nulls": [(rng.choice([None, None, 1, rng.randrange(9)]), rng.choice([None, rng.randrange(500)])) for _ in range(n)],
        "text": [(rng.choice(["", "a", "é", "zz"]) + str(rng.randrange(60)), i) for i in range(n)],
        "equal": [(1, 2)] * n,
    }[kind]
    key = "string" if kind == "text" else "long"
    df = spark.createDataFrame(data, f"a {key}, b long").repartition(4).cache()
    index = paging.KeyIndex(df, ["a", "b"], rows_at_once=25, bounds=6)
    for limit, offset in ((7, 3), (60, 95), (50, 380), (5, 400)):
        got = [tuple(r) for r in index.page(limit, offset).collect()]
        assert got == brute_page(data, limit, offset), (limit, offset)
    # small ranges are all that is read, unless rows are equal in every key
    for r, _, _ in index.pieces(index.all, 95, 60):
        assert r.rows <= 25 or len(r.fixed) == 2


def test_page_filter_reaches_the_scan(spark, tmp_path):
    spark.range(0, 100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")) \
        .repartition(4).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    got = paging.page(df, ["k"], 50, 70_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan" in plan.split("PushedFilters")[1] and "RangePartitioning" not in plan
    assert [r.v for r in got.collect()] == list(range(140_000, 140_100, 2))
