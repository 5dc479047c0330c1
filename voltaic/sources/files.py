"""File sources and sinks: Parquet datasets, part-file folders, CSV tables.

Writers take the output path from the caller (on a cluster: shared storage;
in tests: a scratch folder under ``spark.checkpoint.dir``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.functions.timefix import instant_to_ntz, nanos_to_micros

THRESHOLD_METRICS_SCHEMA = T.StructType([
    T.StructField("threshold", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("true_positives", T.LongType()),
    T.StructField("false_positives", T.LongType()),
    T.StructField("false_negatives", T.LongType()),
])


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "snappy") -> str:
    """K1/K2: overwrite a Parquet dataset (optionally one folder per key)."""
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: scan a derived dataset, optionally asserting its schema."""
    df = spark.read.parquet(path)
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"dataset at {path} lacks columns {missing}")
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


#: Stores whose files a task opens by itself, to read no more than their ends.
ARROW_STORES = ("file", "hdfs", "s3", "gs")
#: Text that ends in an offset from UTC after a time of day.
_OFFSET = r":[0-9.]+ *(?:Z|UTC|[+-][0-9]{1,2}(?::?[0-9]{2})?)$"


def list_files(spark: SparkSession, path: str, glob: str = "*", contents: bool = False) -> DataFrame:
    """The files below a folder as a table ``path, length, modified`` (and ``content``, only if asked for).

    A missing folder gives an empty table.
    """
    from pyspark.errors import AnalysisException

    extra = ["content"] if contents else []
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    try:
        files = reader.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length long, modificationTime timestamp, content binary")
    return files.select("path", "length", F.col("modificationTime").alias("modified"), *extra)


def read_footers(spark: SparkSession, path: str, time_col: str = "time") -> DataFrame:
    """``path, kind, columns`` of every Parquet file of a folder, in one job: a task reads the footers of its files.

    ``kind`` is what the time column holds (wall, instant, nanos, text, other, or nothing), ``columns`` the serialized Arrow
    schema of the others. Where a task cannot open the store itself
    (``ARROW_STORES``), Spark hands it the files whole. A file that is no
    Parquet file raises.
    """
    store = path.split(":", 1)[0] if ":" in path else "file"
    contents = store not in ARROW_STORES
    files = list_files(spark, path, contents=contents)
    files = files.select("path", "content" if contents else F.lit(None).cast("binary").alias("content"))

    # Nested, so that they travel with the plan: workers need not have this package.
    def time_kind(schema) -> str:
        import pyarrow as pa

        if time_col not in schema.names:
            return ""
        kind = schema.field(time_col).type
        if pa.types.is_timestamp(kind):
            return "nanos" if kind.unit == "ns" else "instant" if kind.tz else "wall"
        return "text" if pa.types.is_string(kind) or pa.types.is_large_string(kind) else "other"

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            paths, kinds, columns = batch.column(0).to_pylist(), [], []
            for i, file in enumerate(paths):
                if batch.column(1)[i].is_valid:
                    source = pa.BufferReader(batch.column(1)[i].as_buffer())
                elif file.startswith("file:"):
                    source = fs.LocalFileSystem().open_input_file("/" + file[5:].lstrip("/"))
                else:
                    system, name = fs.FileSystem.from_uri(file)
                    source = system.open_input_file(name)
                with source:
                    schema = pq.read_schema(source).remove_metadata()
                kinds.append(time_kind(schema))
                others = [pa.field(f.name, f.type) for f in schema if f.name != time_col]
                columns.append(pa.schema(others).serialize().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(kinds, pa.string()), pa.array(columns, pa.binary())],
                names=["path", "kind", "columns"])

    return files.mapInArrow(footers, "path string, kind string, columns binary")


def _merged(columns: list[bytes]) -> T.StructType:
    """All columns of some files by name; a column of two types raises."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    schemas = [pa.ipc.read_schema(pa.py_buffer(c)) for c in columns]
    try:
        merged = pa.unify_schemas(schemas)
    except (pa.ArrowInvalid, pa.ArrowTypeError) as e:
        raise ValueError(f"CANNOT_MERGE_SCHEMAS: {e}") from e
    return from_arrow_schema(merged, prefer_timestamp_ntz=True)


def wall_time(time: Column, kind: str) -> Column:
    """A time column of a kind as TIMESTAMP_NTZ, whatever the session's zone: wall clocks as they
    are, instants and texts with an offset on the UTC clock, nanoseconds rounded down, bad text NULL."""
    if kind == "wall":
        return time
    if kind == "instant":
        return instant_to_ntz(time)
    if kind == "nanos":
        return nanos_to_micros(time, "truncate")
    text = F.trim(time.cast("string"))
    return F.when(text.rlike(_OFFSET), instant_to_ntz(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


_SCANNED = {"wall": T.TimestampNTZType(), "instant": T.TimestampType(), "nanos": T.LongType(), "text": T.StringType()}


def load_folder(spark: SparkSession, path: str, schema: T.StructType | None = None,
                time_col: str = "time") -> DataFrame:
    """All part files of a folder as one table, lenient time coercion.

    Files with differing columns are merged by name (missing -> NULL); a column
    of two types raises. Times may be wall clocks, instants, nanoseconds or text,
    each file its own; the result has TIMESTAMP_NTZ on every route (see
    ``wall_time``). A missing folder or one without part files gives an empty
    DataFrame (with ``schema`` when given).

    One job reads all footers, inside tasks, and counts files by schema; the
    driver meets each distinct schema once. A folder of one kind of time is then
    scanned as a folder. With more, each kind is scanned by its files' names,
    which Spark's file index keeps on the driver for any scan.
    """
    footers = read_footers(spark, path, time_col)
    by_schema = footers.groupBy("kind", "columns").agg(F.count(F.lit(1)).alias("files")).collect()
    if not by_schema:
        return spark.createDataFrame([], schema or T.StructType([]))
    columns = _merged([bytes(r["columns"]) for r in by_schema])
    kinds = sorted({r["kind"] for r in by_schema})
    names: dict[str, list[str]] = {k: [path] for k in kinds}
    if len(kinds) > 1:
        names = {r["kind"]: r["paths"] for r in footers.groupBy("kind").agg(F.collect_list("path").alias("paths")).collect()}
    if "nanos" in kinds:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    out = None
    for kind in kinds:
        scan = _scan_kind(spark, path, names[kind], columns, kind, time_col)
        out = scan if out is None else out.unionByName(scan, allowMissingColumns=True)
    return out


def _scan_kind(spark: SparkSession, path: str, files: list[str], columns: T.StructType, kind: str, time_col: str) -> DataFrame:
    """Files of one kind of time by their known columns: no further look at their footers for the schema."""
    reader = spark.read if files == [path] else spark.read.option("basePath", path)
    if kind == "other":  # dates and numbers: their own type, as text
        scan = reader.option("mergeSchema", "true").parquet(*files)
    else:
        held = [T.StructField(time_col, _SCANNED[kind])] if kind else []
        scan = reader.schema(T.StructType([*held, *columns.fields])).parquet(*files)
    if not kind:
        return scan
    return scan.withColumn(time_col, wall_time(F.col(time_col), kind))


def export_csv(df: DataFrame, path: str) -> str:
    """K7: all columns as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV read (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def threshold_lookup(metrics: DataFrame, threshold: float, digits: int = 6) -> DataFrame:
    """The metrics row for a chosen threshold, compared after rounding
    (the thresholds come from text, so exact float equality is fragile)."""
    return metrics.filter(F.round(F.col("threshold"), digits) == F.round(F.lit(float(threshold)), digits))
