"""Bronze ingestion: CSV files -> stamped tables.

* ``read_csv``: columns are taken by the names in the header row, typed by the
  *declared* schema per table (schema inference is an opt-in: it costs an extra
  pass over the files and can change types from one delivery to the next). A
  value that does not fit its type stops the load; ``malformed_rows`` shows such rows.
* ``read_deliveries``: deliveries whose headers differ, as one table; columns that a delivery may lack have declared defaults.
* ``stamp``: adds ``ingestion_ts`` = the run timestamp.
* ``write_table``: full overwrite (schema replaced) or append. Append is
  kept for parity with the append-style loader; re-running it duplicates rows,
  which the duplicate-key checks then report.
* ``ingest_all``: the load loop over (file, table) pairs -- one independent
  Spark job per table.
* ``table_profile`` / ``preview``: catalog inspection as DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.context import RunContext
from tidemark.functions.core import union_all
from tidemark.sources.schemas import BRONZE_SCHEMAS, SOURCE_FILES, STAMP

CSV_OPTIONS = {"header": "true", "mode": "FAILFAST", "dateFormat": "yyyy-MM-dd",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}
KNOWN_READ_OPTIONS = {"header", "inferSchema", "sep", "delimiter", "quote", "escape", "mode", "nullValue",
                      "emptyValue", "dateFormat", "enforceSchema", "timestampFormat", "encoding", "multiLine", "comment"}


def _by_name(spark: SparkSession, path: str, table: str, options: dict[str, str]) -> StructType:
    """The declared schema in the order of the file's header; columns that are not declared are read as strings."""
    header = spark.read.options(**{**options, "mode": "PERMISSIVE"}).csv(path).columns
    declared = {f.name: f for f in BRONZE_SCHEMAS[table].fields}
    missing = [n for n in declared if n not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    return StructType([declared.get(n, StructField(n, StringType())) for n in header])


def read_csv(spark: SparkSession, path: str, table: str | None = None, infer: bool = False,
             **options: str) -> DataFrame:
    """CSV scan with a header; typed by the declared schema of ``table`` unless ``infer``.

    Columns are matched by name: they may come in any order, columns that are
    not declared are left out, and a missing one is an error.
    """
    unknown = set(options) - KNOWN_READ_OPTIONS
    if unknown:
        raise ValueError(f"unsupported CSV read options: {sorted(unknown)}")
    chosen = {**CSV_OPTIONS, **options}
    reader = spark.read.options(**chosen)
    if infer or table is None:
        return reader.option("inferSchema", "true").csv(path)
    # enforceSchema=false: every file's header is compared with the names, not only the first one's.
    return reader.option("enforceSchema", "false").schema(_by_name(spark, path, table, chosen)).csv(path).select(*BRONZE_SCHEMAS[table].fieldNames())


def deliveries(spark: SparkSession, base_path: str) -> list[str]:
    """The deliveries under ``base_path``, by name: each file or folder in it is one (names with a leading ``_`` or ``.`` are not)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base_path)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().toString() for f in found if not f.getPath().getName().startswith(("_", ".")))


def read_deliveries(spark: SparkSession, paths: Iterable[str], table: str, defaults: dict[str, Any] | None = None,
                    **options: str) -> DataFrame:
    """All deliveries of ``table`` as one frame with its declared columns, whatever columns each has and in whatever order.

    Deliveries with equal headers are one scan; scans are united by name. The files inside one delivery share its header
    (any other one stops the load). A declared column that a delivery lacks takes its value of ``defaults`` (which may be None: NULL) and is an
    error without one; columns that are not declared are left out. A NULL that a delivery does hold stays NULL. Without a path the frame is empty.
    """
    unknown = set(options) - KNOWN_READ_OPTIONS
    if unknown:
        raise ValueError(f"unsupported CSV read options: {sorted(unknown)}")
    declared, defaults = BRONZE_SCHEMAS[table], defaults or {}
    undeclared = set(defaults) - set(declared.fieldNames())
    if undeclared:
        raise ValueError(f"defaults for columns that {table} does not have: {sorted(undeclared)}")
    chosen = {**CSV_OPTIONS, **options}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = tuple(spark.read.options(**{**chosen, "mode": "PERMISSIVE"}).csv(path).columns)
        by_header.setdefault(header, []).append(path)
    parts = []
    for header, same in by_header.items():
        missing = [n for n in declared.fieldNames() if n not in header and n not in defaults]
        if missing:
            raise ValueError(f"{same}: the header lacks {missing}, which have no default")
        schema = StructType([declared[n] if n in declared.fieldNames() else StructField(n, StringType()) for n in header])
        rows = spark.read.options(**chosen).option("enforceSchema", "false").schema(schema).csv(same)
        parts.append(rows.select(*[F.col(f.name) if f.name in header else F.lit(defaults[f.name]).cast(f.dataType).alias(f.name) for f in declared]))
    return union_all(parts) if parts else spark.createDataFrame([], declared)


def malformed_rows(spark: SparkSession, path: str, table: str, **options: str) -> DataFrame:
    """The raw lines of which some value does not fit the declared schema, as column ``line``."""
    chosen = {**CSV_OPTIONS, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    schema = StructType([*_by_name(spark, path, table, {**CSV_OPTIONS, **options}).fields, StructField("_line", StringType())])
    rows = spark.read.options(**chosen).schema(schema).csv(path)
    # Always true, but it needs every column: Spark only parses what a query asks for.
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in BRONZE_SCHEMAS[table].fieldNames()])) >= 0
    return rows.filter(F.col("_line").isNotNull() & parsed).select(F.col("_line").alias("line"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(header="true", dateFormat="yyyy-MM-dd",
                                timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumn(STAMP, ctx.stamp())


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet",
                as_table: bool = False) -> None:
    """Write a bronze table to a path (or a catalog table when ``as_table``)."""
    w = df.write.format(fmt).mode(mode)
    if mode == "overwrite":
        w = w.option("overwriteSchema", "true") if fmt == "delta" else w
    if as_table:
        w.saveAsTable(target)
    else:
        w.save(target)


def ingest(spark: SparkSession, source: str, table: str, target: str, ctx: RunContext,
           mode: str = "overwrite", fmt: str = "parquet") -> None:
    write_table(stamp(read_csv(spark, source, table), ctx), target, mode=mode, fmt=fmt)


def ingest_all(spark: SparkSession, base_path: str, target_root: str, ctx: RunContext,
               files: Iterable[tuple[str, str]] = SOURCE_FILES, mode: str = "overwrite",
               fmt: str = "parquet") -> dict[str, str]:
    """Load every (file, table) pair under ``base_path`` into ``target_root/<table>``."""
    out = {}
    for file_name, table in files:
        target = f"{target_root.rstrip('/')}/{table}"
        ingest(spark, f"{base_path.rstrip('/')}/{file_name}", table, target, ctx, mode=mode, fmt=fmt)
        out[table] = target
    return out


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column: position, declared type, row count and NULL count.

    Types come from the schema; counts from one aggregate pass per table.
    """
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.count(F.when(F.col(f.name).isNull(), 1)).alias(f"_n{i}") for i, f in enumerate(fields)])
        rows = F.array(*[
            F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"_n{i}").alias("null_count"))
            for i, f in enumerate(fields)
        ])
        parts.append(agg.select(F.lit(name).alias("table_name"), F.col("_rows").alias("row_count"),
                                F.explode(rows).alias("c"))
                     .select("table_name", "c.ordinal", "c.column_name", "c.data_type", "row_count",
                             "c.null_count"))
    return union_all(parts)


def preview(df: DataFrame, order_by: str, n: int = 10) -> DataFrame:
    """First ``n`` rows in ``order_by`` order (a deterministic ``LIMIT``)."""
    return df.orderBy(F.col(order_by).asc()).limit(n)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` -- the target database of the bronze and gold tables."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def current_schema(spark: SparkSession) -> DataFrame:
    """The session's current schema, as one row."""
    return spark.sql("SELECT current_schema() AS current_schema")


def ingest_all_to_catalog(spark: SparkSession, base_path: str, database: str, ctx: RunContext,
                          files: Iterable[tuple[str, str]] = SOURCE_FILES, mode: str = "overwrite",
                          fmt: str = "parquet", prefix: str = "bronze_") -> dict[str, str]:
    """The load loop writing catalog tables ``<database>.<prefix><table>``."""
    ensure_schema(spark, database)
    out = {}
    for file_name, table in files:
        name = f"{database}.{prefix}{table}"
        df = stamp(read_csv(spark, f"{base_path.rstrip('/')}/{file_name}", table), ctx)
        write_table(df, name, mode=mode, fmt=fmt, as_table=True)
        out[table] = name
    return out


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``SHOW TABLES`` as a DataFrame: (database, table_name, is_temporary)."""
    rows = [(t.database, t.name, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "database string, table_name string, is_temporary boolean")
