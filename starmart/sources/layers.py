"""Parquet layers: write a model into its layer, read it back, summarise.

Layout ``<root>/<layer>/<table>/<version>``; every write publishes a new version
(re-runs give the same tables).  A written table is also how lineage is cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("raw", "staging", "intermediate", "marts", "metrics")


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_layer(df: DataFrame, root: str, layer: str, table: str,
                partition_by: Sequence[str] = (), bool_as_int: bool = False) -> str:
    """Materialise ``df`` as ``<root>/<layer>/<table>`` (replace) and return the path.

    The data goes to a new version folder that is published when the job has
    succeeded (``replace_parquet``), so a failed or killed job leaves the
    previous table as it is (lost executors are already retried by Spark).
    ``partition_by`` writes Hive-style folders (T2-02), which later filters
    on those columns prune.  ``bool_as_int`` stores flags as 0/1 ints.
    """
    if bool_as_int:
        df = bools_to_int(df)
    path = layer_path(root, layer, table)
    replace_parquet(df, path, partition_by)
    return path


_MARKERS = "_published"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _published(fs, make, path: str) -> list[str]:
    """Names of the table's markers, oldest first: ``<number>_<version folder>``."""
    folder = make(f"{path}/{_MARKERS}")
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def replace_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` to a new version folder of the table at ``path`` and publish it.

    Publishing creates one empty marker whose name gives a number and the
    version; readers take the highest (``read_table``).  Nothing is renamed
    or overwritten, so at no time is there no table, on object stores as
    well.  The version before stays for readers that still use it, older
    ones are removed.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{version}")
    fs, make = _file_system(spark, path)
    known = _published(fs, make, path)
    number = int(known[-1].split("_")[0]) + 1 if known else 1
    fs.create(make(f"{path}/{_MARKERS}/{number:012d}_{version}"), False).close()
    for old in known[:-1]:
        fs.delete(make(f"{path}/{old.split('_', 1)[1]}"), True)
        fs.delete(make(f"{path}/{_MARKERS}/{old}"), False)


def current_path(spark: SparkSession, path: str) -> str:
    """Folder of the published version of the table at ``path`` (a plain folder is itself)."""
    fs, make = _file_system(spark, path)
    known = _published(fs, make, path)
    return f"{path}/{known[-1].split('_', 1)[1]}" if known else path


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The published version of a table written by ``replace_parquet``."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(current_path(spark, path))


def read_layer(spark: SparkSession, root: str, layer: str, table: str,
               schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, layer_path(root, layer, table), schema)


def bools_to_int(df: DataFrame) -> DataFrame:
    """BOOLEAN columns -> 0/1 INT for stores without a boolean type (P-24)."""
    return df.select(*[F.col(f.name).cast("int").alias(f.name)
                       if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
                       for f in df.schema.fields])


def table_counts(tables: dict[str, DataFrame], name_col: str = "table_name",
                 count_col: str = "row_count") -> DataFrame:
    """One row per table with its row count, ordered by name (S-13, S-18).

    The counts are a union of per-table aggregates evaluated as one job.
    """
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
               .select(F.lit(name).alias(name_col), F.col(count_col))
             for name, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def layer_summary(spark: SparkSession, root: str, layer: str,
                  tables: Sequence[str]) -> DataFrame:
    """Row counts of the given tables of a layer (missing tables are skipped)."""
    from starmart.session import path_exists
    found = {t: read_layer(spark, root, layer, t) for t in tables
             if path_exists(spark, layer_path(root, layer, t))}
    return table_counts(found).orderBy("table_name")


# ---------------------------------------------------------------- catalog (S-10, S-12, S-14)


def ensure_database(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (S-12)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def save_table(df: DataFrame, database: str, table: str) -> str:
    """Replace ``database.table`` with ``df`` (drop + create as select, S-10)."""
    ensure_database(df.sparkSession, database)
    full = f"`{database}`.`{table}`"
    df.write.mode("overwrite").format("parquet").saveAsTable(full)
    return full


def publish_table(df: DataFrame, database: str, table: str, root: str) -> str:
    """Create or replace ``database.table`` with ``df`` under ``root`` (S-10).

    The data goes to a new version folder (``replace_parquet``); the catalog's
    entry is then pointed at it in one step, so there is always a table, and a
    reader of the version before keeps its files.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}/{database}'")
    path = f"{root}/{database}/{table}"
    replace_parquet(df, path)
    at, full = current_path(spark, path), f"`{database}`.`{table}`"
    if spark.catalog.tableExists(f"{database}.{table}"):
        known = spark.table(full).schema
        if known == spark.read.parquet(at).schema:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{at}'")
            spark.catalog.refreshTable(full)
            return full
        spark.sql(f"DROP TABLE {full}")  # other columns; an external table's files stay
    spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{at}'")
    return full


def catalog_counts(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """Every table that the catalog lists in ``databases``, with its row count (S-13, S-14)."""
    out = None
    for r in list_tables(spark, databases).collect():  # one row a table
        one = spark.table(f"`{r.database}`.`{r.table_name}`").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(r.database).alias("database"), F.lit(r.table_name).alias("table_name"),
            F.lit(r.table_type).alias("table_type"), "row_count")
        out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], "database string, table_name string, table_type string, row_count bigint")
    return out


def register_layer(spark: SparkSession, root: str, layer: str, tables: Sequence[str]) -> list[str]:
    """Expose written layer folders as catalog tables ``layer.table`` (no copy)."""
    from starmart.session import path_exists
    ensure_database(spark, layer)
    done = []
    for t in tables:
        path = layer_path(root, layer, t)
        if not path_exists(spark, path):
            continue
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{t}`")
        at = current_path(spark, path)  # register again after the next write
        spark.sql(f"CREATE TABLE `{layer}`.`{t}` USING parquet LOCATION '{at}'")
        done.append(f"{layer}.{t}")
    return done


def list_tables(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """Catalog listing, one row per table (S-14), ordered by database and name."""
    dbs = databases or [d.name for d in spark.catalog.listDatabases()]
    entries = [(db, t.name, t.tableType) for db in dbs
               for t in spark.catalog.listTables(db) if not t.isTemporary]
    return spark.createDataFrame(entries, "database string, table_name string, table_type string") \
        .orderBy("database", "table_name")


def write_bucketed(df: DataFrame, database: str, table: str, buckets: int,
                   keys: Sequence[str], sort: bool = True) -> str:
    """Save ``df`` as a catalog table bucketed (and sorted) by ``keys``.

    Two tables bucketed the same way on their join key join without a
    shuffle on either side (e.g. the fact by ``student_key`` and the student
    dimension by its key), which removes the largest exchange of a star
    join that is run many times.  ``buckets`` should give files of about
    128-512 MB at the target size.
    """
    ensure_database(df.sparkSession, database)
    full = f"`{database}`.`{table}`"
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(full)
    return full
