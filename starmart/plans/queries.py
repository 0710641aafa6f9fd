"""Registered queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the whole given tables; none samples, caps or subsets rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import driver as D
from starmart.plans import models as M

Query = Callable[[SparkSession, str], DataFrame]


def metric_distribution(spark, sf):
    return M.metric_distribution(D.mart_fact(spark, sf))


def metric_band_by_group(spark, sf):
    return M.metric_bmi_by_gender(D.mart_fact(spark, sf))


def metric_adequacy(spark, sf):
    return M.metric_sleep_adequacy(D.mart_fact(spark, sf))


def metric_weekly(spark, sf):
    return M.metric_weekly_activity(D.mart_fact(spark, sf))


def metric_risk(spark, sf):
    return M.metric_risk_correlations(D.mart_fact(spark, sf))


def class_balance(spark, sf):
    return M.class_balance(M.metric_distribution(D.mart_fact(spark, sf)))


def star_enriched(spark, sf):
    return D.enriched(spark, sf)


def mart_fact(spark, sf):
    return D.mart_fact(spark, sf)


QUERIES: dict[str, Query] = {
    "metric_distribution": metric_distribution,
    "metric_band_by_group": metric_band_by_group,
    "metric_adequacy": metric_adequacy,
    "metric_weekly": metric_weekly,
    "metric_risk": metric_risk,
    "class_balance": class_balance,
    "star_enriched": star_enriched,
    "mart_fact": mart_fact,
}


# ---------------------------------------------------------------- staging projections (P-01 ... P-07)

from pyspark.sql import functions as F  # noqa: E402

from starmart.functions import features as feat  # noqa: E402
from starmart.functions.dates import to_date, week_of_month as _wom  # noqa: E402
from starmart.operators import checks as C  # noqa: E402
from starmart.operators import profile as P  # noqa: E402
from starmart.plans import serving as V  # noqa: E402
from starmart.sources import contract as K  # noqa: E402
from starmart.sources.layers import bools_to_int, table_counts  # noqa: E402
from starmart.specs import DRIVER_SCHEMAS  # noqa: E402

LOOKUP_ORDER = 7
PAGE_FILTERS = {"health_condition": "1-urgent", "gender": "", "bmi_class": None,
                "diet_type": None}


def stage_lineitem(spark, sf):
    return D.stage_fact(D.read(spark, sf, "lineitem"))


def stage_orders(spark, sf):
    t = D.tables(spark, sf, "orders", "customer")
    return D.stage_students(t["orders"], t["customer"])


def stage_part(spark, sf):
    return D.stage_lifestyle(D.read(spark, sf, "part"))


def stage_supplier(spark, sf):
    t = D.tables(spark, sf, "supplier", "nation", "region")
    return D.stage_place(t["supplier"], t["nation"], t["region"])


def pseudonymised_dim(spark, sf):
    return D.mart_dim(spark, sf)


def age_derived(spark, sf):
    s = stage_orders(spark, sf)
    return s.select("o_orderkey", "date_of_birth",
                    feat.age_years("date_of_birth", "age_raw", D.AS_OF).alias("age_derived"))


# ---------------------------------------------------------------- features (P-14 ... P-21)


def band_quantity(spark, sf):
    li = D.read(spark, sf, "lineitem")
    return li.select(*D.FACT_KEYS, "l_quantity",
                     feat.band("l_quantity", feat.BMI_BANDS, feat.BMI_ELSE).alias("bmi_class"))


def threshold_flags(spark, sf):
    li = D.read(spark, sf, "lineitem")
    return li.select(*D.FACT_KEYS,
                     feat.flag_ge("l_discount", D.DRIVER_PARAMS.sleep_threshold)
                     .alias("sleep_adequate"),
                     feat.flag_ge("l_tax", D.DRIVER_PARAMS.water_threshold)
                     .alias("hydration_adequate"))


def composite_score(spark, sf):
    return D.enriched(spark, sf).select(*D.FACT_KEYS, "composite_activity_score",
                                        "health_trend_indicator")


def trend_band(spark, sf):
    return (D.enriched(spark, sf).groupBy("health_condition", "health_trend_indicator")
            .agg(F.count(F.lit(1)).alias("record_count")))


def ordinal_encode(spark, sf):
    f = D.stage_fact(D.read(spark, sf, "lineitem"))
    p = D.DRIVER_PARAMS
    return f.select(*D.FACT_KEYS,
                    feat.ordinal("sleep_quality", p.sleep_order).alias("sleep_quality_encoded"),
                    feat.ordinal("smoking_alcohol", p.smoking_order)
                    .alias("smoking_alcohol_encoded"))


def one_hot_encode(spark, sf):
    c = D.read(spark, sf, "customer")
    g = F.lower(F.btrim("c_mktsegment"))
    return c.select("c_custkey", *feat.one_hot(g, D.DRIVER_PARAMS.gender_values))


def week_of_month(spark, sf):
    li = D.read(spark, sf, "lineitem")
    d = to_date("l_shipdate")
    return li.select(*D.FACT_KEYS, d.alias("full_date"), _wom(d).alias("week_of_month"))


# ---------------------------------------------------------------- serving reads (V-01 ... V-08)


def list_records_page(spark, sf):
    # The four fact keys are not unique in every extract: break ties by the
    # other record columns so the page is deterministic.
    return V.list_students(D.mart_fact(spark, sf), limit=50, offset=100,
                           key_cols=D.FACT_KEYS, tie_break=True, **PAGE_FILTERS)


def get_record(spark, sf):
    return V.get_student(D.mart_fact(spark, sf), {"l_orderkey": LOOKUP_ORDER},
                         key_cols=D.FACT_KEYS)


def metric_filtered_sorted(spark, sf):
    return V.risk_correlations(M.metric_risk_correlations(D.mart_fact(spark, sf)),
                               health_condition="2-high", physical_activity_level="active")


def weekly_filtered(spark, sf):
    return V.weekly_activity(M.metric_weekly_activity(D.mart_fact(spark, sf)),
                             health_condition="3-medium", year=1997, month=0)


def serving_promoted(spark, sf):
    return bools_to_int(D.mart_fact(spark, sf))


def serving_sample(spark, sf):
    return V.sample_students(D.mart_dim(spark, sf), 3, ("student_key", "o_orderkey"))


# ---------------------------------------------------------------- contract, layers, ingest


CONTRACT_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                   "events")


def contract_report(spark, sf):
    reports = {}
    for t in CONTRACT_TABLES:
        df = spark.read.parquet(f"{sf.rstrip('/')}/{t}.parquet")  # actual file schema
        reports[t] = K.table_contract(df, t, DRIVER_SCHEMAS[t], min_rows=1)
    return K.contract_all(reports)


def row_parity(spark, sf):
    t = D.tables(spark, sf, "lineitem", "orders", "customer", "part", "supplier", "nation",
                 "region")
    pairs = {
        "lineitem": (t["lineitem"], D.stage_fact(t["lineitem"])),
        "orders": (t["orders"], D.stage_students(t["orders"], t["customer"])),
        "part": (t["part"], D.stage_lifestyle(t["part"])),
        "supplier": (t["supplier"], D.stage_place(t["supplier"], t["nation"], t["region"])),
    }
    src = table_counts({k: v[0] for k, v in pairs.items()}, count_col="source_rows")
    stg = table_counts({k: v[1] for k, v in pairs.items()}, count_col="staged_rows")
    return (src.join(stg, "table_name")
            .withColumn("parity_ok", F.col("source_rows") == F.col("staged_rows")))


def layer_summary(spark, sf):
    return table_counts({t: D.read(spark, sf, t) for t in D.TABLES})


def csv_roundtrip_coerce(spark, sf):
    from starmart.session import scratch_path
    from starmart.sources.csv import coerce, read_csv_raw, write_csv_extract
    from starmart.specs import TableSpec
    cust = D.read(spark, sf, "customer")
    path = scratch_path(spark, "customer-csv")
    write_csv_extract(cust, path)
    spec = TableSpec("customer", tuple((f.name, f.dataType)
                                       for f in DRIVER_SCHEMAS["customer"].fields))
    return coerce(read_csv_raw(spark, path, spec), spec)


INGEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def ingest_tables(spark, sf):
    """CSV extracts of the star tables ingested into typed Parquet (S-05 ... S-08).

    Each table is exported as a headed CSV extract, then ``ingest_all`` reads
    it as text, coerces it, writes Parquet and records an audit row; row,
    NULL-key and cast-failure counts come from the ingest pass itself.  The
    result compares the audit with a recount of the written Parquet.
    """
    from starmart.session import run_concurrently, scratch_path
    from starmart.sources.csv import write_csv_extract
    from starmart.sources.ingest import ingest_all
    from starmart.specs import TableSpec
    root = scratch_path(spark, "ingest")
    specs = {}
    for t in INGEST_TABLES:
        fields = DRIVER_SCHEMAS[t].fields
        specs[t] = TableSpec(t, tuple((f.name, f.dataType) for f in fields),
                             required=(fields[0].name,), key=fields[0].name)
    run_concurrently([(write_csv_extract, D.read(spark, sf, t), f"{root}/csv/{t}")
                      for t in INGEST_TABLES])
    res = ingest_all(spark, f"{root}/csv", specs, {t: t for t in INGEST_TABLES},
                     f"{root}/raw", audit_path=f"{root}/audit")
    # One row per table: bounded, built from the ingest pass's observed metrics.
    observed = spark.createDataFrame(
        [(r.table, r.null_counts[specs[r.table].key], sum(r.cast_failures.values()))
         for r in res.values()],
        "table_name string, null_keys long, cast_failures long")
    audit = spark.read.parquet(f"{root}/audit").select("table_name", "row_count")
    from starmart.sources.layers import read_table
    written = table_counts({t: read_table(spark, f"{root}/raw/{t}") for t in INGEST_TABLES},
                           count_col="parquet_rows")
    return audit.join(written, "table_name").join(observed, "table_name")


def partitioned_stage(spark, sf):
    """Staged fact written as Hive-partitioned Parquet by (year, month) (T2-02).

    The write needs no shuffle: each task writes its rows into the folders of
    the months it holds.  Read back, a filter on year or month prunes folders
    before any file is opened; here every partition is summarised.
    """
    from starmart.session import scratch_path
    from starmart.sources.layers import read_layer, write_layer
    root = scratch_path(spark, "partitioned")
    write_layer(D.stage_fact(D.read(spark, sf, "lineitem")), root, "staging", "lineitem",
                partition_by=("year", "month"))
    staged = read_layer(spark, root, "staging", "lineitem")
    return (staged.groupBy(F.col("year").cast("int").alias("year"),
                           F.col("month").cast("int").alias("month"))
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.min("full_date").alias("first_date"),
                 F.max("full_date").alias("last_date")))


# ---------------------------------------------------------------- profiles and checks (Q-01 ... Q-05)


def null_profile(spark, sf):
    li = P.null_profile(D.read(spark, sf, "lineitem"), table="lineitem")
    od = P.null_profile(D.read(spark, sf, "orders"), table="orders")
    return li.unionByName(od)


DUP_COLUMNS = (("customer", "c_name"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"),
               ("part", "p_type"))


def duplicate_profile(spark, sf):
    parts = [P.duplicate_profile(D.read(spark, sf, t), c, table=t) for t, c in DUP_COLUMNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_failures(spark, sf):
    return C.unique_failures(D.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


MART_CHECKS = C.CheckSpec(
    unique=[D.FACT_KEYS],
    not_null=["health_condition", "bmi_class", "health_trend_indicator",
              "composite_activity_score", "bmi", "heart_rate"],
    accepted={"health_condition": ("1-urgent", "2-high", "3-medium", "4-not specified",
                                   "5-low"),
              "bmi_class": ("Underweight", "Normal", "Overweight", "Obese")},
    ranges={"bmi": (1.0, 50.0), "composite_activity_score": (0.0, 100.0)},
)


def check_report(spark, sf):
    return C.run_checks({"mart_fact": stored(spark, D.mart_fact(spark, sf), "mart_fact")},
                        {"mart_fact": MART_CHECKS})


def stored(spark, df, name):
    """``df`` written once to shared scratch and read back, for several uses."""
    from starmart.session import scratch_path
    from starmart.sources.layers import read_table, replace_parquet
    path = scratch_path(spark, name)
    replace_parquet(df, path)
    return read_table(spark, path)


def not_null_failures(spark, sf):
    """Rows of the staged fact failing a declared not-null test (date parts)."""
    f = D.stage_fact(D.read(spark, sf, "lineitem"))
    return C.not_null_failures(f, "full_date").select(*D.FACT_KEYS)


QUERIES.update({
    "stage_lineitem": stage_lineitem,
    "stage_orders": stage_orders,
    "stage_part": stage_part,
    "stage_supplier": stage_supplier,
    "pseudonymised_dim": pseudonymised_dim,
    "age_derived": age_derived,
    "band_quantity": band_quantity,
    "threshold_flags": threshold_flags,
    "composite_score": composite_score,
    "trend_band": trend_band,
    "ordinal_encode": ordinal_encode,
    "one_hot_encode": one_hot_encode,
    "week_of_month": week_of_month,
    "list_records_page": list_records_page,
    "get_record": get_record,
    "metric_filtered_sorted": metric_filtered_sorted,
    "weekly_filtered": weekly_filtered,
    "serving_promoted": serving_promoted,
    "serving_sample": serving_sample,
    "contract_report": contract_report,
    "row_parity": row_parity,
    "layer_summary": layer_summary,
    "csv_roundtrip_coerce": csv_roundtrip_coerce,
    "ingest_tables": ingest_tables,
    "partitioned_stage": partitioned_stage,
    "null_profile": null_profile,
    "duplicate_profile": duplicate_profile,
    "unique_failures": unique_failures,
    "check_report": check_report,
    "not_null_failures": not_null_failures,
})


# ---------------------------------------------------------------- Tier 2: prose-specified operators

from starmart.functions.numeric import count_if, ravg, rate  # noqa: E402
from starmart.operators import incremental as INC  # noqa: E402
from starmart.operators import masking as MASK  # noqa: E402
from starmart.operators import quality as Q  # noqa: E402
from starmart.operators import scd as SCD  # noqa: E402
from starmart.operators import trends as TR  # noqa: E402
from starmart.operators.metrics import grouped_metrics  # noqa: E402

SCD_AS_OF = "1998-01-01"
STRATUM = "5-low"
CLASS_BOUNDS = {c: (15.0, 25.0) for c in ("1-urgent", "2-high", "3-medium", "4-not specified",
                                          "5-low")}
AGE_BANDS = ((3.0, "1-2"), (5.0, "3-4"))
DRIFT_SPLIT = "2024-01-16"
FRESH_AS_OF = "2024-02-01"
FRESH_MAX_LAG = 30
MERGE_FROM = "2000-01-01"


def scd_current(spark, sf):
    return SCD.current(stage_orders(spark, sf), "is_current", D.CURRENT_STATUS)


def scd_as_of(spark, sf):
    # The latest order of each customer first (one row for each task and
    # customer is shuffled), then the customer's columns.
    t = D.tables(spark, sf, "orders", "customer")
    dated = t["orders"].withColumn("start_date", to_date("o_orderdate"))
    last = SCD.as_of(dated, ["o_custkey"], "start_date", SCD_AS_OF, tie_break=["o_orderkey"])
    return D.stage_students(last, t["customer"])


def weekly_per_user(spark, sf):
    return TR.weekly_means(D.read(spark, sf, "events"), "user_id", "ts", "value")


def trend_direction(spark, sf):
    return TR.trend_direction(weekly_per_user(spark, sf), "user_id", tolerance=0.5)


def stratified_class(spark, sf):
    return D.mart_fact(spark, sf).where(F.col("health_condition") == STRATUM).select(
        *D.FACT_KEYS, "health_condition", "bmi_class", "composite_activity_score")


def weekly_active(spark, sf):
    return TR.active_per_period(D.read(spark, sf, "events"), "user_id", "ts")


FK_RELATIONSHIPS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
)


def fk_failures(spark, sf):
    parts = []
    for child, ck, parent, pk in FK_RELATIONSHIPS:
        bad = C.relationship_failure_count(D.read(spark, sf, child), D.read(spark, sf, parent),
                                           ck, pk)
        parts.append(bad.select(F.lit(f"{child}.{ck}->{parent}.{pk}").alias("relationship"),
                                "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


DOMAIN_CHECKS = {
    "orders": C.CheckSpec(accepted={"o_orderstatus": ("O", "F"),
                                    "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM",
                                                        "4-NOT SPECIFIED", "5-LOW")}),
    "lineitem": C.CheckSpec(accepted={"l_returnflag": ("A", "N", "R"),
                                      "l_linestatus": ("O", "F")}),
    "customer": C.CheckSpec(accepted={"c_mktsegment": ("AUTOMOBILE", "BUILDING", "FURNITURE",
                                                       "HOUSEHOLD", "MACHINERY")}),
}
RANGE_CHECKS = {
    "lineitem": C.CheckSpec(ranges={"l_quantity": (1.0, 50.0), "l_discount": (0.0, 0.1),
                                    "l_tax": (0.0, 0.08)}),
    "orders": C.CheckSpec(ranges={"o_totalprice": (0.0, 500000.0)}),
    "part": C.CheckSpec(ranges={"p_size": (1, 50)}),
    "customer": C.CheckSpec(ranges={"c_acctbal": (-999.99, 9999.99)}),
}


def accepted_value_failures(spark, sf):
    return C.run_checks({t: D.read(spark, sf, t) for t in DOMAIN_CHECKS}, DOMAIN_CHECKS)


def range_failures(spark, sf):
    return C.run_checks({t: D.read(spark, sf, t) for t in RANGE_CHECKS}, RANGE_CHECKS)


def class_thresholds(spark, sf):
    return Q.class_thresholds(class_balance(spark, sf), CLASS_BOUNDS)


def pii_scan(spark, sf):
    return C.pii_scan(D.mart_dim(spark, sf).drop("o_orderkey"), "mart_dim",
                      ["national_id", "date_of_birth", "c_name"])


def cohort_means(spark, sf):
    return grouped_metrics(
        D.mart_fact(spark, sf), ["gender"],
        [ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("bmi").alias("mean_bmi"),
         rate("sleep_adequate").alias("sleep_adequacy_rate_pct"),
         rate("hydration_adequate").alias("hydration_rate_pct")])


def age_groups(spark, sf):
    fact = D.mart_fact(spark, sf).withColumn(
        "age_group", feat.band("age_derived", AGE_BANDS, "5+"))
    return grouped_metrics(fact, ["age_group"],
                           [ravg("composite_activity_score").alias("avg_activity_score")],
                           shares={"pct_of_total": ()})


def monthly_cohort(spark, sf):
    return grouped_metrics(
        D.mart_fact(spark, sf), ["year", "month", "gender"],
        [ravg("composite_activity_score").alias("avg_activity_score"),
         ravg("bmi").alias("avg_bmi"),
         count_if("sleep_adequate").alias("sleep_adequate_count")])


def user_trajectory(spark, sf):
    return TR.trajectory(D.read(spark, sf, "events"), "user_id", "ts", "value")


# ---------------------------------------------------------------- Tier 3: future-work operators


def incremental_merge(spark, sf):
    orders = D.read(spark, sf, "orders")
    batch = orders.where(F.col("o_orderdate") >= F.lit(MERGE_FROM).cast("timestamp_ntz")) \
        .withColumn("o_orderstatus", F.lit("F"))
    return INC.merge(orders, batch, ["o_orderkey"])


def drift_psi(spark, sf):
    ev = D.read(spark, sf, "events")
    split = F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    return Q.psi(ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split), "event_type")


def freshness(spark, sf):
    checks = [("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts")]
    parts = [Q.freshness(D.read(spark, sf, t), t, c, FRESH_AS_OF, FRESH_MAX_LAG)
             for t, c in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stream_weekly(spark, sf):
    from starmart.session import scratch_path
    from starmart.streaming.weekly import run_weekly_stream
    out = scratch_path(spark, "stream-weekly")
    run_weekly_stream(spark, f"{sf.rstrip('/')}/events.parque[t]", DRIVER_SCHEMAS["events"],
                      "ts", ["event_type"], "value", out, mode="complete")
    return spark.read.parquet(out)


ROLE_POLICIES = {
    "regional_analyst": MASK.RolePolicy(
        columns={"national_id_hashed": "null", "student_key": "drop", "start_date": "drop",
                 "end_date": "drop"},
        row_filter="severity_level = 'europe'"),
}


def role_view(spark, sf):
    return MASK.role_view(D.mart_fact(spark, sf), ROLE_POLICIES, "regional_analyst")


QUERIES.update({
    "scd_current": scd_current,
    "scd_as_of": scd_as_of,
    "weekly_per_user": weekly_per_user,
    "trend_direction": trend_direction,
    "stratified_class": stratified_class,
    "weekly_active": weekly_active,
    "fk_failures": fk_failures,
    "accepted_value_failures": accepted_value_failures,
    "range_failures": range_failures,
    "class_thresholds": class_thresholds,
    "pii_scan": pii_scan,
    "cohort_means": cohort_means,
    "age_groups": age_groups,
    "monthly_cohort": monthly_cohort,
    "user_trajectory": user_trajectory,
    "incremental_merge": incremental_merge,
    "drift_psi": drift_psi,
    "freshness": freshness,
    "stream_weekly": stream_weekly,
    "role_view": role_view,
})


# ---------------------------------------------------------------- more serving routes and checks


def distribution_filtered(spark, sf):
    return V.health_distribution(M.metric_distribution(D.mart_fact(spark, sf)),
                                 health_condition="1-urgent", gender=None, diet_type="")


def bmi_filtered(spark, sf):
    return V.bmi_by_gender(M.metric_bmi_by_gender(D.mart_fact(spark, sf)), gender="building",
                           health_condition=None, bmi_class="Obese")


def sleep_filtered(spark, sf):
    return V.sleep_adequacy(M.metric_sleep_adequacy(D.mart_fact(spark, sf)),
                            health_condition="4-not specified")


def serving_verify(spark, sf):
    return V.verify_counts(spark, {"fact_health_transformed": D.mart_fact(spark, sf),
                                   "dim_student_transformed": D.mart_dim(spark, sf),
                                   "mrt_health_distribution": metric_distribution(spark, sf),
                                   "mrt_missing": None})


COMPLETENESS_COLUMNS = ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate")


def completeness_drift(spark, sf):
    li = D.read(spark, sf, "lineitem")
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    base = Q.completeness(li.where(F.col("l_shipdate") < split), COMPLETENESS_COLUMNS, "base")
    cur = Q.completeness(li.where(F.col("l_shipdate") >= split), COMPLETENESS_COLUMNS, "cur")
    return base.join(cur, "column_name").withColumn(
        "delta", F.col("cur_complete") - F.col("base_complete"))


QUERIES.update({
    "distribution_filtered": distribution_filtered,
    "bmi_filtered": bmi_filtered,
    "sleep_filtered": sleep_filtered,
    "serving_verify": serving_verify,
    "completeness_drift": completeness_drift,
})


def scd_history(spark, sf):
    """Each order as a version of its customer, valid until the next order (T2-03)."""
    staged = stage_orders(spark, sf).select("student_key", "o_orderkey", "start_date",
                                            "health_condition")
    return SCD.derive_validity(staged, ["student_key"], "start_date", ["o_orderkey"])


QUERIES["scd_history"] = scd_history


# ---------------------------------------------------------------- CSV text, history, publishing


def _csv_text(spark, sf, table):
    """A table of quoted text and line breaks through a CSV extract and back (S-03, S-04)."""
    from starmart.session import scratch_path
    from starmart.sources.csv import coerce, read_csv_raw, write_csv_extract
    from starmart.specs import TableSpec
    df = D.read(spark, sf, table)
    path = scratch_path(spark, f"{table}-csv")
    write_csv_extract(df, path)
    spec = TableSpec(table, tuple((f.name, f.dataType) for f in df.schema.fields))
    return coerce(read_csv_raw(spark, path, spec, multiline=True, na_tokens=("",)), spec)


def csv_text_documents(spark, sf):
    return _csv_text(spark, sf, "documents")


def csv_text_pages(spark, sf):
    return _csv_text(spark, sf, "pages")


def scd_valid_at(spark, sf):
    """Versions of the order history valid on a date, by start and end (T2-03)."""
    return SCD.valid_at(scd_history(spark, sf), SCD_AS_OF, "start_date", "valid_to")


def deep_page(spark, sf):
    """A page over a nullable key that reaches into its NULLs, found by range counts (O-04)."""
    from starmart.operators import paging
    history = scd_history(spark, sf)
    return paging.page_deep(history, ["valid_to", "o_orderkey"], limit=300, offset=1300)


def strata(spark, sf):
    """Every class with its bands, so that no minority class is missing (T2-06)."""
    return grouped_metrics(D.mart_fact(spark, sf), ["health_condition", "bmi_class"],
                           [ravg("composite_activity_score").alias("avg_activity_score")],
                           shares={"pct_of_total": (),
                                   "pct_within_condition": ("health_condition",)})


def get_record_full_key(spark, sf):
    """One record by all four key columns: the first of an order (V-02)."""
    fact = D.mart_fact(spark, sf)
    first = fact.where(F.col("l_orderkey") == LOOKUP_ORDER).agg(
        F.min(F.struct(*D.FACT_KEYS)).alias("k")).first()["k"]
    key = first.asDict() if first is not None else dict.fromkeys(D.FACT_KEYS, 1)
    return V.get_student(fact, key, key_cols=D.FACT_KEYS)


def _publish(spark, sf):
    """Both marts and the five metrics promoted to serving tables: the star is computed once."""
    from starmart.session import scratch_path
    from starmart.sources.layers import read_table
    root = scratch_path(spark, "serving")
    fact = stored(spark, D.mart_fact(spark, sf), "publish-fact")
    tables = {"fact_health_transformed": fact, "dim_student_transformed": D.mart_dim(spark, sf)}
    tables |= {name: fn(fact) for name, fn in M.METRICS.items()}
    for name, df in tables.items():
        V.promote(df, path=f"{root}/{name}")
    return {name: read_table(spark, f"{root}/{name}") for name in tables}


def published_counts(spark, sf):
    """Row counts of the published tables (S-16 ... S-18)."""
    return V.verify_counts(spark, {**_publish(spark, sf), "mrt_missing": None})


def published_fact(spark, sf):
    """The promoted fact read back, flags as 0/1 (S-16)."""
    return _publish(spark, sf)["fact_health_transformed"]


def published_risk(spark, sf):
    """The promoted risk metric read back (S-17)."""
    return _publish(spark, sf)["mrt_risk_correlations"]


def feature_sample(spark, sf):
    """First three records with their features (S-20)."""
    from starmart.operators import paging
    columns = ["bmi_class", "composite_activity_score", "health_trend_indicator",
               "sleep_quality_encoded", "physical_activity_encoded", "smoking_alcohol_encoded"]
    fact = D.mart_fact(spark, sf).select(*D.FACT_KEYS, *columns)
    return paging.top_n(fact, [*D.FACT_KEYS, *columns], 3)


def metric_sample(spark, sf):
    """First five rows of the distribution metric (S-20)."""
    from starmart.operators import paging
    return paging.top_n(metric_distribution(spark, sf),
                        ["health_condition", "gender", "diet_type"], 5)


# Checks where failures exist: orders that are not current have no features,
# lines of such orders no student; text holds addresses and numbers.


def _orders_with_features(spark, sf):
    t = D.tables(spark, sf, "orders", "customer")
    current = D.student_features(t["orders"], t["customer"]).select(
        "o_orderkey", "national_id_hashed", "age_derived")
    return t["orders"].join(current, "o_orderkey", "left")


def null_profile_found(spark, sf):
    return P.null_profile(_orders_with_features(spark, sf), table="orders_with_features")


def not_null_found(spark, sf):
    return C.not_null_failures(_orders_with_features(spark, sf), "national_id_hashed") \
        .select("o_orderkey", "o_orderstatus")


def orphans_found(spark, sf):
    """Order lines whose order is not current, counted by key before the join (T2-07)."""
    li, orders = D.read(spark, sf, "lineitem"), D.read(spark, sf, "orders")
    current = orders.where(F.upper(F.btrim("o_orderstatus")) == D.CURRENT_STATUS)
    return C.relationship_failure_count(li, current, "l_orderkey", "o_orderkey").select(
        F.lit("lineitem.l_orderkey->current orders.o_orderkey").alias("relationship"), "failures")


TIGHT_RANGES = {
    "lineitem": C.CheckSpec(ranges={"l_quantity": (5.0, 45.0), "l_discount": (0.01, 0.09),
                                    "l_tax": (0.01, 0.07)}),
    "customer": C.CheckSpec(ranges={"c_acctbal": (0.0, 9000.0)}),
}


def range_failures_found(spark, sf):
    return C.run_checks({t: D.read(spark, sf, t) for t in TIGHT_RANGES}, TIGHT_RANGES)


def pii_scan_text(spark, sf):
    docs, pages = D.read(spark, sf, "documents"), D.read(spark, sf, "pages")
    return C.pii_scan(docs.select("text"), "documents").unionByName(
        C.pii_scan(pages.select("html"), "pages"))


def completeness_found(spark, sf):
    """Completeness of features before and after a date (T3-03): not all are there."""
    df = _orders_with_features(spark, sf)
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    columns = ("o_totalprice", "national_id_hashed", "age_derived")
    base = Q.completeness(df.where(F.col("o_orderdate") < split), columns, "base")
    cur = Q.completeness(df.where(F.col("o_orderdate") >= split), columns, "cur")
    return base.join(cur, "column_name").withColumn(
        "delta", F.col("cur_complete") - F.col("base_complete"))


def csv_contract_checks(spark, sf):
    """Contract of CSV extracts, one without its PII column and one missing (S-01, S-02, S-11)."""
    from starmart.session import scratch_path
    from starmart.sources.csv import write_csv_extract
    from starmart.specs import TableSpec
    root = scratch_path(spark, "contract")
    customer = D.read(spark, sf, "customer")
    write_csv_extract(customer, f"{root}/customer")
    write_csv_extract(customer.drop("c_name"), f"{root}/unnamed")
    reports = {}
    for name in ("customer", "unnamed", "missing"):
        spec = TableSpec(name, tuple((f.name, f.dataType) for f in customer.schema.fields),
                         pii=("c_name",), min_rows=1)
        reports[name] = K.csv_contract(spark, f"{root}/{name}", spec)
    rows = F.when(F.col("check_name") == "min_rows", F.col("observed"))
    return K.contract_all(reports).select("table_name", "check_name", "passed",
                                          rows.alias("row_count"))


QUERIES.update({
    "csv_contract_checks": csv_contract_checks,
    "csv_text_documents": csv_text_documents,
    "csv_text_pages": csv_text_pages,
    "scd_valid_at": scd_valid_at,
    "deep_page": deep_page,
    "strata": strata,
    "get_record_full_key": get_record_full_key,
    "published_counts": published_counts,
    "published_fact": published_fact,
    "published_risk": published_risk,
    "feature_sample": feature_sample,
    "metric_sample": metric_sample,
    "null_profile_found": null_profile_found,
    "not_null_found": not_null_found,
    "orphans_found": orphans_found,
    "range_failures_found": range_failures_found,
    "pii_scan_text": pii_scan_text,
    "completeness_found": completeness_found,
})

from starmart.plans.lifecycle import QUERIES as _LIFECYCLE  # noqa: E402

QUERIES.update(_LIFECYCLE)
