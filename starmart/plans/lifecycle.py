"""Queries over data that changes: loads, versions, streams, quarantine, layers and their gate.

Each reads whole driver tables, like those in ``queries``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmart.functions.dates import to_date
from starmart.operators import checks as C
from starmart.operators import masking as MASK
from starmart.operators import quality as Q
from starmart.operators import scd as SCD
from starmart.operators import states as ST
from starmart.plans import driver as D
from starmart.plans import layered as L
from starmart.session import scratch_path
from starmart.specs import DRIVER_SCHEMAS

VERSION_DAYS = 120


def scd_point_in_time(spark, sf):
    """Every order line with the version of its customer on the day it was shipped (T2-03).

    An order is a version of its customer; one that is finished ends after 120
    days (so there are gaps), the others have no end.
    """
    t = D.tables(spark, sf, "lineitem", "orders")
    owner = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("student_key"))
    facts = t["lineitem"].select(*D.FACT_KEYS, to_date("l_shipdate").alias("full_date")).join(owner, "l_orderkey", "left")
    began = to_date("o_orderdate")
    versions = t["orders"].select(
        F.col("o_custkey").alias("student_key"), "o_orderkey", F.lower("o_orderpriority").alias("health_condition"),
        began.alias("valid_from"), F.when(F.col("o_orderstatus") == "F", F.date_add(began, VERSION_DAYS)).alias("valid_to"))
    return SCD.point_in_time(facts, versions, ["student_key"], "full_date", "valid_from", "valid_to",
                             ["o_orderkey", "health_condition"], tie_break=["o_orderkey"])


STATE_GROUP = ("ship_year", "l_returnflag", "l_linestatus")
STATE_MEASURES = ("l_extendedprice", "l_discount")


def incremental_metrics(spark, sf):
    """Metrics from stored states: the lower half of the orders is loaded, then all that is new, then
    the second load is given again and changes nothing (T3-01)."""
    lines = D.read(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"), "l_returnflag", "l_linestatus", *STATE_MEASURES, "l_orderkey")
    half = lines.agg((F.max("l_orderkey") / 2).cast("long")).first()[0] or 0
    path = scratch_path(spark, "states")
    for batch in (lines.where(F.col("l_orderkey") <= half), lines, lines):
        ST.load(spark, path, batch, STATE_GROUP, STATE_MEASURES, "l_orderkey", ["ship_year"])
    states = ST.read_states(spark, path, lines, STATE_GROUP, STATE_MEASURES, "l_orderkey")
    done = ST.finish_states(states, STATE_GROUP, STATE_MEASURES)
    return done.select("*", *[F.round(f"{m}_stddev", 6).alias(f"{m}_deviation") for m in STATE_MEASURES]) \
        .drop(*[f"{m}_stddev" for m in STATE_MEASURES])


STREAM_SPLIT, LATE_EVERY, ALERT_ABOVE = "2024-01-20", 20, 49.0


def stream_append(spark, sf):
    """Weekly windows of a stream that is given in two phases, as they close (T3-02).

    The first phase holds the events before a date but for every twentieth one;
    the second the others and these late ones.  What is late for a closed
    window is dropped, the last batch is replayed, and closed windows with a
    high average raise an alert.
    """
    from starmart.streaming.weekly import forget_last_commit, run_weekly_stream
    events = D.read(spark, sf, "events")
    early = (F.col("ts") < F.lit(STREAM_SPLIT).cast("timestamp_ntz")) & (F.col("event_id") % LATE_EVERY != 0)
    root = scratch_path(spark, "stream-append")
    given, out, alerts, checkpoint = (f"{root}/{x}" for x in ("in", "out", "alerts", "checkpoint"))

    def drain():
        # Whole phases: a bound on files would split one into batches and move the watermark within it.
        run_weekly_stream(spark, given, DRIVER_SCHEMAS["events"], "ts", ["event_type"], "value", out, checkpoint,
                          mode="append", alert_path=alerts, alert_above=ALERT_ABOVE, max_files_per_trigger=2**31 - 1)

    events.where(early).write.mode("append").parquet(given)
    drain()
    events.where(~early).write.mode("append").parquet(given)
    drain()
    forget_last_commit(spark, checkpoint)
    drain()
    closed = spark.read.parquet(out).drop("batch_id")
    raised = spark.read.parquet(alerts).select("week_start", "event_type", F.lit(True).alias("raised"))
    return closed.join(raised, ["week_start", "event_type"], "left").withColumn(
        "alert", F.coalesce("raised", F.lit(False))).drop("raised")


def drift_psi_numeric(spark, sf):
    """Drift of the price between order lines of up to 40 pieces before a date and all after it (T3-03).

    The price is NULL where there is no discount; later lines of more pieces lie above the baseline.
    """
    price = F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).alias("price")
    lines = D.read(spark, sf, "lineitem")
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    base = lines.where((F.col("l_shipdate") < split) & (F.col("l_quantity") <= 40)).select(price)
    return Q.psi_numeric(base, lines.where(F.col("l_shipdate") >= split).select(price), "price", bins=10)


QUARANTINED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def quarantine_lines(spark, sf):
    """Orders as CSV lines, some too short, too long or badly quoted, split into rows and raw lines (T2-01)."""
    from starmart.sources.csv import coerce, land_quarantine, read_csv_raw
    from starmart.specs import TableSpec
    orders = D.read(spark, sf, "orders")
    kind, sep = F.col("o_orderkey") % 50, F.lit(",")
    fields = [F.col(c).cast("string") for c in QUARANTINED]
    line = F.concat_ws(",", *fields)
    line = (F.when(kind == 7, F.concat_ws(",", *fields[:3]))
            .when(kind == 8, F.concat(line, F.lit(",surplus")))
            .when(kind == 9, F.concat(fields[0], sep, F.lit('"'), F.concat_ws(",", *fields[1:])))
            .otherwise(line))
    root = scratch_path(spark, "quarantine")
    # Lines as they are: neither the separator nor the quote of this writer occurs in them.
    orders.select(line.alias(",".join(QUARANTINED))).write.options(header=True, sep="\x01", quote="").csv(f"{root}/csv")
    schema = {f.name: f.dataType for f in DRIVER_SCHEMAS["orders"].fields}
    spec = TableSpec("orders", tuple((c, schema[c]) for c in QUARANTINED))
    raw = read_csv_raw(spark, f"{root}/csv", spec, quarantine=True)
    good, bad, seen = land_quarantine(raw, f"{root}/bronze")
    rows = coerce(good, spec).select(F.lit("row").alias("kind"), *QUARANTINED, F.lit(None).cast("string").alias("raw_line"))
    lines = bad.select(F.lit("line").alias("kind"), *[F.lit(None).cast(schema[c]).alias(c) for c in QUARANTINED], "raw_line")
    return rows.unionByName(lines).select("*", F.lit(seen["lines"]).cast("long").alias("lines_seen"),
                                          F.lit(seen["malformed"]).cast("long").alias("malformed_seen"))


def unique_report(spark, sf):
    """Several keys of the order lines, tested in one scan (Q-03)."""
    keys = [D.FACT_KEYS, ("l_orderkey", "l_linenumber"), "l_orderkey", ("l_partkey", "l_suppkey"), "l_shipdate"]
    return C.unique_report(D.read(spark, sf, "lineitem"), "lineitem", keys)


GRANT_ROLES = ("europe_analyst", "everywhere", "stranger")


def role_grants(spark, sf):
    """Rows that roles may read, by a table of grants derived from the regions (T3-05).

    One role holds one region, one holds all, one isn't known and gets nothing.
    """
    regions = D.read(spark, sf, "region").select(F.lower(F.trim("r_name")).alias("region"))
    grants = regions.where(F.col("region") == "europe").select(F.lit("europe_analyst").alias("role"), "region") \
        .unionByName(regions.select(F.lit("everywhere").alias("role"), "region"))
    policies = {"europe_analyst": MASK.RolePolicy(columns={"student_key": "null"}), "everywhere": MASK.RolePolicy()}
    fact = D.enriched(spark, sf).select(*D.FACT_KEYS, "student_key", "severity_level", "bmi")
    out = None
    for role in GRANT_ROLES:
        seen = MASK.granted_view(fact, policies, grants, role, {"severity_level": "region"})
        seen = seen.groupBy("severity_level").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("student_key").alias("n_students"),
            F.sum(F.col("bmi").cast("long")).alias("bmi_total")).select(F.lit(role).alias("role"), "*")
        out = seen if out is None else out.unionByName(seen)
    return out


def catalog_tables(spark, sf):
    """Tables published twice to a catalog database and counted through the catalog (S-10, S-12 ... S-14).

    ``rows_before`` is what a reader that opened the first version still sees after the second came.
    """
    from starmart.sources.layers import catalog_counts, publish_table
    database, root = f"marts_{uuid.uuid4().hex[:8]}", scratch_path(spark, "catalog")
    t = D.tables(spark, sf, "orders", "customer", "supplier")
    current = {"orders": t["orders"].where(F.col("o_orderstatus") == "O"), "customer": t["customer"], "supplier": t["supplier"]}
    before = {}
    for name, df in current.items():
        publish_table(df, database, name, root)
        before[name] = spark.table(f"{database}.{name}")
    for name in current:
        publish_table(t[name], database, name, root)
    old = None
    for name, df in before.items():
        one = df.agg(F.count(F.lit(1)).alias("rows_before")).select(F.lit(name).alias("table_name"), "rows_before")
        old = one if old is None else old.unionByName(one)
    return catalog_counts(spark, [database]).drop("database").join(old, "table_name")


def layers_gate(spark, sf):
    """Bronze, silver and gold twice: the first run passes its gate, the second fails one (T2-17, Q-05).

    Counts are those of the tables that the manifest names, so of the first run.
    """
    root = scratch_path(spark, "layers")
    sources = D.tables(spark, sf, "lineitem", "orders", "customer", "part", "supplier", "nation", "region")

    def silver(bronze):
        return {"orders": D.stage_students(bronze["orders"], bronze["customer"]), "lineitem": D.stage_fact(bronze["lineitem"]),
                "part": D.stage_lifestyle(bronze["part"])}

    def gold(tables):
        monthly = tables["lineitem"].groupBy("year", "month").agg(F.count(F.lit(1)).alias("record_count"))
        lines = tables["lineitem"].join(tables["part"], F.col("l_partkey") == F.col("p_partkey"))
        diets = lines.groupBy("diet_type", "physical_activity_level").agg(
            F.count(F.lit(1)).alias("record_count"), F.min("bmi").alias("min_bmi"), F.max("bmi").alias("max_bmi"))
        return {"monthly": monthly, "diets": diets}

    def checks(most):
        return {"monthly": C.CheckSpec(unique=[("year", "month")], not_null=["year", "month"], ranges={"month": (1, most)}),
                "diets": C.CheckSpec(ranges={"min_bmi": (1.0, 50.0)})}

    runs = [(run, L.run_layers(spark, root, run, sources, silver, gold, checks(most))) for run, most in (("first", 12), ("second", 11))]
    outcome = spark.createDataFrame([(run, r.published) for run, r in runs], "run string, passed boolean")
    failures = None
    for run, r in runs:
        one = r.report.agg(F.count(F.lit(1)).alias("n_checks"), F.sum(F.when(F.col("failures") > 0, 1).otherwise(0)).alias("n_failed"))
        one = one.select(F.lit(run).alias("run"), "n_checks", "n_failed")
        failures = one if failures is None else failures.unionByName(one)
    counts = L.published_counts(spark, root).select(F.col("run_id").alias("run"), "layer", "table_name", "row_count")
    return outcome.join(failures, "run").join(counts, "run", "left")


QUERIES = {
    "scd_point_in_time": scd_point_in_time,
    "incremental_metrics": incremental_metrics,
    "stream_append": stream_append,
    "drift_psi_numeric": drift_psi_numeric,
    "quarantine_lines": quarantine_lines,
    "unique_report": unique_report,
    "role_grants": role_grants,
    "catalog_tables": catalog_tables,
    "layers_gate": layers_gate,
}
