"""Scans and sinks: CSV in, Parquet between layers, CSV reports and JSON metadata out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources.datasets import DATASETS, Dataset

CORRUPT = "_corrupt_record"
#: Endings of the folders of an overwrite: rows not yet in place, and the table they replace.
STAGED, REPLACED = ".staged", ".replaced"
#: File in a bucketed table's folder: key, number of buckets and the name to scan it under.
BUCKETS = "_buckets"


def read_csv(spark: SparkSession, path: str | list[str], dataset: Dataset, multi_line: bool | None = None) -> DataFrame:
    """Scan a raw CSV table under its declared schema.

    Malformed fields become NULL and the whole line is kept in ``_corrupt_record``.
    """
    return (
        spark.read.schema(f"{dataset.schema}, {CORRUPT} string")
        .option("header", True)
        .option("multiLine", dataset.multi_line if multi_line is None else multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def dataset_name(file_name: str, prefix: str = "") -> str:
    """Table name of a raw file: its stem without a source prefix and the ``_dataset`` suffix."""
    stem = file_name.rstrip("/").rsplit("/", 1)[-1].removesuffix(".csv")
    return stem.removeprefix(prefix).removesuffix("_dataset")


def discover(spark: SparkSession, raw_dir: str, prefix: str = "") -> dict[str, str]:
    """``{table: path}`` of the CSV files (or directories) in a folder of any Hadoop file system."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(raw_dir)
    entries = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    paths = sorted(entry.getPath().toString() for entry in entries)
    found: dict[str, str] = {}
    for path in paths:
        if path.endswith(".csv"):
            name = dataset_name(path, prefix)
            if name in found:
                raise ValueError(f"two files for table {name}: {found[name]} and {path}")
            found[name] = path
    return found


def ingest(spark: SparkSession, raw_dir: str, bronze_dir: str, prefix: str = "") -> list[str]:
    """Copy every raw CSV file to Parquet; returns the tables written.

    Files of no declared table are kept as well, all columns as text.
    """
    written = []
    for name, path in discover(spark, raw_dir, prefix).items():
        known = DATASETS.get(name)
        df = read_csv(spark, path, known) if known else spark.read.option("header", True).option("escape", '"').csv(path)
        write_table(df, f"{bronze_dir}/{name}")
        written.append(name)
    return written


def _folder(spark: SparkSession, path: str):
    """File system and Hadoop path of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; the one before, where an overwrite was lost between its two renames."""
    files, folder = _folder(spark, path)
    before = folder.suffix(REPLACED)
    lost = not files.exists(folder) and files.exists(before)
    return spark.read.parquet(before.toString() if lost else path)


def write_table(df: DataFrame, path: str, bucket_key: str | None = None, buckets: int = 0) -> None:
    """Overwrite a Parquet table. The rows are written beside it first and the two folders swapped then, so a
    lost job leaves the old table as it was, and ``df`` may read the table it replaces. (In stores where a rename
    copies, the swap takes as long as a copy; the old table stays readable until it ends.)

    With ``bucket_key`` the files are ``buckets`` buckets of that column, for ``read_bucketed``. Pass rows that are
    partitioned by it already (``df.repartition(buckets, bucket_key)``), else every task writes a file a bucket.
    A bucket is read by one task, so the key should be (nearly) unique.
    """
    spark = df.sparkSession
    files, folder = _folder(spark, path)
    name = uuid.uuid4().hex
    staged, before = folder.suffix(f"{STAGED}-{name}"), folder.suffix(REPLACED)
    try:
        if bucket_key is None:
            df.write.parquet(staged.toString())
        else:
            _write_buckets(df, files, staged, f"bucketed_{name}", bucket_key, buckets)
    except Exception:
        files.delete(staged, True)
        raise
    old = _bucketing(spark, path)
    if files.exists(folder):
        files.delete(before, True)
        _rename(files, folder, before)
    _rename(files, staged, folder)
    files.delete(before, True)
    if old:
        spark.sql(f"DROP TABLE IF EXISTS {old['name']}")


def _write_buckets(df: DataFrame, files, staged, name: str, key: str, buckets: int) -> None:
    # Spark buckets tables of the catalog only; an external one leaves its files when it is dropped.
    spark = df.sparkSession
    try:
        df.write.bucketBy(buckets, key).format("parquet").option("path", staged.toString()).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    out = files.create(spark._jvm.org.apache.hadoop.fs.Path(staged, BUCKETS))
    out.write(bytearray(json.dumps({"name": name, "key": key, "buckets": buckets}), "utf-8"))
    out.close()


def _bucketing(spark: SparkSession, path: str) -> dict | None:
    files, folder = _folder(spark, path)
    note = spark._jvm.org.apache.hadoop.fs.Path(folder, BUCKETS)
    if not files.exists(note):
        return None
    # Spark's own readers skip files whose names begin with an underscore.
    stream = files.open(note)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table written with ``bucket_key``, so that joins of two such tables on it need no shuffle; any other table
    as ``read_table``. The folder goes into the session's catalog under the name it was written with, as an
    external table; the next overwrite takes it out again.
    """
    found = _bucketing(spark, path)
    if not found:
        return read_table(spark, path)
    if not spark.catalog.tableExists(found["name"]):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {found['name']} ({columns}) USING parquet "
            f"CLUSTERED BY (`{found['key']}`) INTO {found['buckets']} BUCKETS LOCATION '{location}'"
        )
    return spark.table(found["name"])


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"could not rename {source.toString()} to {target.toString()}")


def register_views(spark: SparkSession, layer_dir: str, names: Iterable[str]) -> None:
    """Make a layer's tables available to ``spark.sql`` under their own names."""
    for name in names:
        read_table(spark, f"{layer_dir}/{name}").createOrReplaceTempView(name)


def write_report(df: DataFrame, path: str) -> None:
    """CSV sink for report results, which are few rows: one file with a header, months as dates."""
    writer = df.coalesce(1).write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", "yyyy-MM-dd").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def rejected(df: DataFrame) -> DataFrame:
    """Lines that did not fit the schema, of a bronze table (or a cached raw scan); none where they weren't recorded."""
    return df.filter(F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False))


def rejected_lines(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """Report row with the number of those lines. Their other fields are kept, so any number passes without ``most``."""
    counted = rejected(df).agg(F.count(F.lit(1)).alias("violations"))
    passed = F.lit(True) if most is None else F.col("violations") <= most
    return counted.select(
        F.lit(name).alias("dataset"), F.lit("rejected_lines").alias("check"), "violations", passed.alias("passed")
    )
