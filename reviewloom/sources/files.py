"""Reading and writing tables, JSON and text artifacts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.plans.shapes import col, literal_rows


def _fields_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line of the files at ``path`` has an odd number of quotes.

    If none has, no quoted field holds a line break.  The search is distributed and ends
    at the first such line.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: str | None = None,
    multi_line: bool | None = None,
    source: str = "file",
) -> DataFrame:
    """CSV with a ``source_dataset`` column taken from the file (or folder) name.

    A source_dataset column in the file is kept.  Spark splits large files among tasks
    unless a field may hold a line break.  ``multi_line`` says whether that is so; left
    out, each path is looked through first.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.schema(schema) if schema else reader
    whole = [p for p in paths if multi_line or (multi_line is None and _fields_span_lines(spark, p))]
    parts = [p for p in paths if p not in whole]
    read = [reader.option("multiLine", kind).csv(some) for kind, some in ((False, parts), (True, whole)) if some]
    pattern = r"([^/]+?)(?:\.[^./]*)?$" if source == "file" else r"([^/]+)/[^/]*$"
    stem = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    named = [
        df if "source_dataset" in df.columns else df.select("*", stem.alias("source_dataset"))
        for df in read
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def read_all(spark: SparkSession, files: Mapping[str, str], **options) -> dict[str, DataFrame]:
    """One table per named file, stamped with that name."""
    return {
        name: read_csv(spark, path, **options).withColumn("source_dataset", F.lit(name))
        for name, path in files.items()
    }


def merge_datasets(tables: Iterable[DataFrame]) -> DataFrame:
    """All rows, union of columns, NULL where a table lacks one."""
    tables = list(tables)
    if not tables:
        raise ValueError("no tables to merge")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.format(fmt).save(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON document per row, NULL fields kept."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(
        "overwrite"
    ).text(path)
    return path


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON artifact; a missing path or a malformed document is an error."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def write_report(lines: DataFrame, path: str) -> str:
    """Report lines (line_no, line) as one text file; a report is a few lines per topic."""
    lines.orderBy("line_no").coalesce(1).select("line").write.mode("overwrite").text(path)
    return path


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of all files below a path; content is pruned."""
    empty = "path string, length bigint, modificationTime timestamp"
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException:
        return spark.createDataFrame([], empty)
    return found.select("path", "length", "modificationTime")


def artifact_status(spark: SparkSession, root: str, expected: Mapping[str, str]) -> DataFrame:
    """Per expected artifact (file or folder below root): exists, bytes, newest change."""
    names = literal_rows(spark, expected.items(), "name string, relative string")
    head = root.rstrip("/").split("/")[-1]
    inside = F.regexp_extract("path", rf"/{re.escape(head)}/([^/]+)", 1)
    found = (
        _files(spark, root)
        .groupBy(inside.alias("relative"))
        .agg(F.sum("length").alias("size_bytes"), F.max("modificationTime").alias("modified_at"))
    )
    return names.join(found, "relative", "left").select(
        "name", "relative", F.col("size_bytes").isNotNull().alias("available"), "size_bytes", "modified_at"
    )


def artifacts_available(status: DataFrame) -> DataFrame:
    return status.agg(F.bool_and("available").alias("all_available"))


def size_mb(spark: SparkSession, path: str) -> DataFrame:
    """Megabytes of a file or folder, NULL when absent."""
    return _files(spark, path).agg((F.sum("length") / (1024 * 1024)).alias("size_mb"))


# --- logged tables --------------------------------------------------------------------
# A small table that several writers change at once.  A write adds an entry, a folder of
# its own name that nobody else touches, and then one record that names the entry, so
# writers cannot undo each other, none has to wait or try again, and an entry whose writer
# was lost is never read.  A read folds the entries in order of time.


def append_entry(df: DataFrame, path: str, written_at: str | None = None) -> str:
    """Add the rows as one entry; returns its name, which sorts by time of writing."""
    now = written_at or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    entry = f"{now}-{uuid.uuid4().hex}"
    df.coalesce(1).write.mode("errorifexists").parquet(f"{path}/data/entry={entry}")
    record = df.sparkSession.createDataFrame([(entry,)], "entry string").coalesce(1)
    record.write.mode("errorifexists").parquet(f"{path}/log/{entry}")
    return entry


def read_entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of all finished entries, with the ``entry`` they came from."""
    with_entry = f"{schema}, entry string"
    try:
        log = spark.read.option("recursiveFileLookup", True).schema("entry string").parquet(f"{path}/log")
    except AnalysisException:
        return spark.createDataFrame([], with_entry)
    paths = [f"{path}/data/entry={r['entry']}" for r in log.collect()]
    return spark.read.schema(with_entry).option("basePath", f"{path}/data").parquet(*paths)


def read_logged(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The table as it stands: for each key the rows of the newest entry that has it."""
    rows = read_entries(spark, path, schema)
    newest = rows.groupBy(key).agg(F.max("entry").alias("newest"))
    kept = rows.join(newest.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key")))
    return kept.where("entry = newest").drop("entry", "newest", "__key")


def rename_dotted(df: DataFrame, by: str = "_") -> DataFrame:
    """Dots in column names replaced, for sinks that reject them."""
    return df.select(*[col(n).alias(n.replace(".", by)) for n in df.columns])
