"""Loads, versions, streams, quarantine, layers and their gate."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from starmart.functions.numeric import exact_stddev
from starmart.operators import checks, masking, quality, scd, states
from starmart.plans import layered
from starmart.sources import csv, layers


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("partitions", [1, 7])
def test_point_in_time_against_plain_code(spark, partitions):
    rng = random.Random(8)
    # Key 1 is hot, several versions start on one day, some end early, some keys, dates and starts are NULL.
    versions = [(rng.choice([1, 1, 1, 2, 3, None]), s, rng.choice([None, s + 3, s + 40]), i)
                for i, s in enumerate(rng.randrange(60) for _ in range(60))] + [(1, None, 5, 99)]
    facts = [(i, rng.choice([1, 1, 1, 1, 2, 4, None]), rng.choice([None, *range(80)])) for i in range(400)]
    facts += [(500, 1, 30)] * 50  # one key and date over several partitions
    v = spark.createDataFrame([(k, day(s), day(e), n) for k, s, e, n in versions], "k long, s date, e date, n long")
    f = spark.createDataFrame([(i, k, day(d)) for i, k, d in facts], "id long, k long, d date").repartition(5)
    got = scd.point_in_time(f, v, ["k"], "d", "s", "e", ["n"], tie_break=["n"], partitions=partitions)
    want = []
    for i, k, d in facts:
        known = [x for x in versions if k is not None and d is not None and x[0] == k and x[1] is not None and x[1] <= d]
        last = max(known, key=lambda x: (x[1], x[3]), default=None)
        ok = last is not None and (last[2] is None or last[2] > d)
        want.append((i, k, day(d), *((day(last[1]), day(last[2]), last[3]) if ok else (None, None, None))))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert any(w[5] is not None for w in want) and any(w[5] is None and w[1] == 1 and w[2] for w in want)


def test_point_in_time_empty_and_clashing(spark):
    f = spark.createDataFrame([(1, 1, day(3))], "id long, k long, d date")
    v = spark.createDataFrame([], "k long, s date, e date, n long")
    assert [tuple(r) for r in scd.point_in_time(f, v, ["k"], "d", "s", "e", ["n"]).collect()] == [(1, 1, day(3), None, None, None)]
    assert scd.point_in_time(f.limit(0), v, ["k"], "d", "s", "e", ["n"]).collect() == []
    with pytest.raises(ValueError, match="both"):
        scd.point_in_time(f.withColumn("n", F.lit(1)), v, ["k"], "d", "s", "e", ["n"])


def test_stddev_has_the_same_bits_in_any_order(spark):
    rng = random.Random(1)
    rows = [(i % 3, round(rng.uniform(1e4, 1e4 + 9), 2)) for i in range(3000)] + [(3, 1.5), (4, None), (5, 0.1), (5, 0.1), (6, 1e300), (6, 2.0), (7, float("nan")), (7, 1.0)]
    df = spark.createDataFrame(rows, "g long, v double")
    seen = [{r.g: r.s for r in df.repartition(n).groupBy("g").agg(exact_stddev("v").alias("s")).collect()} for n in (1, 3, 11)]
    for g in (0, 1, 2, 5):
        values = [v for k, v in rows if k == g]
        mean = math.fsum(values) / len(values)
        assert seen[0][g] == pytest.approx(math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1)), rel=1e-9)
        assert seen[0][g] == seen[1][g] == seen[2][g]
    assert seen[0][3] is None and seen[0][4] is None and seen[0][5] == 0.0 and math.isnan(seen[0][7])


GROUP, MEASURES = ["day", "kind"], ["v", "w"]


def test_loads_equal_the_whole(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice("ab"), rng.choice([None, 0.25, 0.1234, rng.randrange(999) / 100]), rng.randrange(99), i) for i in range(500)]
    df = spark.createDataFrame(rows, "day int, kind string, v double, w long, seq long")

    def table(batches, path):
        for low, high in batches:
            states.load(spark, path, df.where((F.col("seq") >= low) & (F.col("seq") < high)), GROUP, MEASURES, "seq", ["day"])
        stored = states.read_states(spark, path, df, GROUP, MEASURES, "seq")
        return sorted(map(repr, states.finish_states(stored, GROUP, MEASURES).collect()))

    whole = table([(0, 500)], f"{tmp_path}/whole")
    # in pieces, one of them empty, given again and overlapping with what is loaded
    assert table([(0, 120), (120, 120), (0, 300), (300, 500), (300, 500), (0, 500)], f"{tmp_path}/parts") == whole
    assert len(whole) == len({(r[0], r[1]) for r in rows})
    with pytest.raises(Exception, match="NULL seq"):
        states.load(spark, f"{tmp_path}/bad", df.withColumn("seq", F.lit(None).cast("long")), GROUP, MEASURES, "seq", ["day"])


def test_unique_report_equals_single_checks(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice([None, 1, 2, 3]), rng.randrange(6), i) for i in range(40)], "a long, b long, c long")
    keys = ["a", ("a", "b"), "c", ("b", "a"), ("a", "b", "c")]
    report = checks.unique_report(df, "m", keys)
    got = {r.column_name: (r.failures, r.surplus_rows) for r in report.collect()}
    for key in keys:
        bad = checks.unique_failures(df, key).collect()
        name = key if isinstance(key, str) else "+".join(key)
        assert got[name] == (len(bad), sum(r.n_rows - 1 for r in bad))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2  # the table once, and the names of the keys
    assert {tuple(r)[1:] for r in checks.unique_report(df.limit(0), "m", ["a", "c"]).collect()} == {("a", "unique", 0, 0), ("c", "unique", 0, 0)}
    run = checks.run_checks({"m": df}, {"m": checks.CheckSpec(unique=["a", "c"])}).collect()
    assert {(r.column_name, r.failures > 0) for r in run} == {("a", True), ("c", False)}


def test_numeric_drift_edges(spark):
    base = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,)] * 4, "x double")
    cur = spark.createDataFrame([(-5.0,), (0.0,), (55.0,), (99.0,), (1e9,), (float("nan"),), (None,)], "x double")
    got = {r.bin: (r.base_count, r.cur_count) for r in quality.psi_numeric(base, cur, "x", bins=4).collect()}
    assert got[None] == (4, 1) and got[0] == (0, 1) and got[5] == (0, 2)
    assert sum(b for b, _ in got.values()) == 104 and [got[i][0] for i in (1, 2, 3, 4)] == [25, 25, 25, 25]
    assert quality.exact_quantiles(base, "x", [0.0, 0.5, 1.0]) == [0.0, 49.0, 99.0]
    one = spark.createDataFrame([(7.0,)] * 5, "x double")
    assert {r.bin: (r.base_count, r.cur_count) for r in quality.psi_numeric(one, base, "x").collect()} == {0: (0, 7), 1: (5, 1), 2: (0, 92), None: (0, 4)}
    none = one.where("x is null")
    assert {r.bin: r.cur_count for r in quality.psi_numeric(none, one, "x").collect()} == {1: 5}


def test_grants(spark):
    df = spark.createDataFrame([("eu", 1), ("eu", 2), ("us", 3), (None, 4)], "region string, v long")
    grants = spark.createDataFrame([("a", "eu"), ("a", "eu"), ("b", "us"), ("b", "eu"), ("c", None)], "role string, area string")
    policies = {"a": masking.RolePolicy(columns={"v": "null"}), "b": masking.RolePolicy(), "c": masking.RolePolicy()}

    def view(role):
        return sorted(map(tuple, masking.granted_view(df, policies, grants, role, {"region": "area"}).collect()))

    assert view("a") == [("eu", None)] * 2
    assert view("b") == [("eu", 1), ("eu", 2), ("us", 3)]
    assert view("c") == [] and view("unknown") == []


def test_catalog_keeps_a_readers_version(spark, tmp_path):
    one = spark.range(3).withColumnRenamed("id", "v")
    name = layers.publish_table(one, "t_catalog", "numbers", str(tmp_path))
    before = spark.table(name)
    layers.publish_table(one.union(one), "t_catalog", "numbers", str(tmp_path))
    assert before.count() == 3 and spark.table(name).count() == 6
    layers.publish_table(one.withColumn("w", F.lit("x")), "t_catalog", "numbers", str(tmp_path))
    assert spark.table(name).columns == ["v", "w"]
    assert [tuple(r) for r in layers.catalog_counts(spark, ["t_catalog"]).collect()] == [("t_catalog", "numbers", "EXTERNAL", 3)]
    spark.sql("DROP DATABASE t_catalog CASCADE")


def test_a_failed_gate_publishes_nothing(spark, tmp_path):
    root = str(tmp_path)

    def run(run_id, rows, least):
        source = {"t": spark.createDataFrame([(i,) for i in range(rows)], "v long")}
        return layered.run_layers(spark, root, run_id, source, lambda b: {"s": b["t"].where("v >= 1")}, lambda s: {"g": s["s"]},
                                  {"g": checks.CheckSpec(ranges={"v": (least, None)})})

    with pytest.raises(Exception):
        layered.published_table(spark, root, "gold", "g")
    assert not run("r0", 9, 5).published
    assert run("r1", 4, 1).published
    failed = run("r2", 8, 3)
    assert not failed.published and "g.v range=2" in failed.reason
    assert layered.published_table(spark, root, "gold", "g").count() == 3
    with pytest.raises(LookupError):
        layered.published_table(spark, root, "gold", "x")
    assert run("r3", 8, 1).published and run("r3", 8, 1).published  # given again: the same tables
    assert {(r.run_id, r.layer, r.row_count) for r in layered.published_counts(spark, root).collect()} == {("r3", "bronze", 8), ("r3", "silver", 7), ("r3", "gold", 7)}


def test_quarantine_counts(spark, tmp_path):
    text = 'a,b\n1,x\n2\n3,y,z\n"4,open\n5,"q,q"\n'
    (tmp_path / "f.csv").write_text(text)
    raw = csv.read_csv_raw(spark, f"{tmp_path}/f.csv", quarantine=True)
    good, bad, seen = csv.land_quarantine(raw, f"{tmp_path}/bronze")
    assert seen == {"lines": 5, "malformed": 3}
    assert sorted(map(tuple, good.collect())) == [("1", "x"), ("5", "q,q")]
    assert sorted(r.raw_line for r in bad.collect()) == ['"4,open', "2", "3,y,z"]
