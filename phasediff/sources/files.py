"""File sources: snapshots, versioned snapshots, newest file, completed sheets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasediff.operators.scratch import scratch_path
from phasediff.schema import canonical_columns

SHEET_PREFIX = "FY24 Change Table "


#: Tasks for each core that list the folders of one level.
LISTING_TASKS = 4


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session within, as before afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_folders(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table in very many folders, each a value of its partition columns.

    Spark lists them in a task each, so starting tasks takes far longer than listing; here a task lists
    its share of the folders. Every folder and file is read as always.
    """
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    with setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks)):
        return spark.read.format(fmt).load(path)


def read_snapshot(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    renames: dict[str, str] | None = None,
    duplicates: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """One snapshot table with canonical column names.

    Headers that differ only by case are told apart by position; `duplicates` lists canonical
    names of which a repeated column is dropped. Spark cannot plan on such columns in a session that
    ignores case, so a table with clashing headers is stored once under its canonical names; any other
    is read lazily.
    """
    own = case_sensitive(spark)

    def load(session: SparkSession) -> DataFrame:
        reader = session.read.format(fmt).options(**options)
        return (reader if schema is None else reader.schema(schema)).load(path)

    given = load(own)
    if len({c.lower() for c in given.columns}) == len(given.columns):
        return canonical_columns(load(spark), renames or {}, duplicates)
    renamed = canonical_columns(given, renames or {}, duplicates)
    stored = scratch_path(spark, "snapshot")
    renamed.write.parquet(stored)
    return spark.read.schema(renamed.schema).parquet(stored)


def case_sensitive(spark: SparkSession) -> SparkSession:
    """A session beside this one that tells names apart by case; it shares everything but settings and views."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own


def read_versions(
    spark: SparkSession, base: str, phases: list[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A fact table stored as `phase=<name>` folders; asking for phases reads only their folders."""
    table = spark.read.format(fmt).load(base)
    return table if phases is None else table.filter(F.col("phase").isin(*phases))


def latest_file(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Path and time of the newest file whose name matches; lock files start with `~`.

    Only file metadata is read, not file contents.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "modificationTime")
    )
    name = F.element_at(F.split("path", "/"), -1)
    return (
        listed.filter(name.rlike(pattern))
        .agg(F.max(F.struct("modificationTime", "path")).alias("newest"))
        .select("newest.path", "newest.modificationTime")
    )


def read_latest(
    spark: SparkSession, folder: str, pattern: str, schema: T.StructType | str, fmt: str = "parquet", **options
) -> DataFrame:
    """The newest table of a folder whose name matches; it is chosen by metadata and read alone.

    A table is a file in the folder or a folder of part files below it.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime")
    )
    root = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/")
    entry = F.regexp_extract("path", rf"\Q{root}\E/+([^/]+)", 1)
    newest = (
        listed.select(entry.alias("entry"), "modificationTime")
        .filter(F.col("entry").rlike(pattern))
        .agg(F.max(F.struct("modificationTime", "entry")).alias("newest"))
        .first()
        .newest
    )
    if newest is None:
        raise FileNotFoundError(f"nothing in {folder} matches {pattern}")
    return spark.read.format(fmt).options(**options).schema(schema).load(f"{folder.rstrip('/')}/{newest.entry}")


def read_many(
    spark: SparkSession, folder: str, name_glob: str, schema: T.StructType | str, fmt: str = "csv", **options
) -> DataFrame:
    """All files below a folder whose name matches, each row with the path it came from."""
    return (
        spark.read.format(fmt)
        .options(**options)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", "true")
        .schema(schema)
        .load(folder)
        .withColumn("file_path", F.url_decode(F.col("_metadata.file_path")))
    )


#: Why rows of a scan of sheets are no rows of a service.
LOCK_FILE = "lock file"
OTHER_FILE = "not a sheet file"
OTHER_TAB = "tab without a service number"


def classified_sheets(rows: DataFrame, prefix: str = SHEET_PREFIX, extension: str = "xlsx") -> DataFrame:
    """Rows of many files with `agency`, `service_id`, `file_name` and, where they are none of a service, `reject`.

    The agency is what the file name has between prefix and extension, the service the first run of three
    or more digits in the tab name. A file may also be a folder of part files with such a name.
    """
    book = F.regexp_extract("file_path", rf"(?:^|[/=])([^/=]+\.\Q{extension}\E)(?:/[^/]*)?$", 1)
    named = rows.withColumn("file_name", F.when(book != "", book).otherwise(F.element_at(F.split("file_path", "/"), -1)))
    keyed = named.withColumns(
        {
            "agency": F.regexp_extract("file_name", rf"^\Q{prefix}\E([^/]+)\.\Q{extension}\E$", 1),
            "service_id": F.regexp_extract("sheet", r"(\d{3,})", 1),
        }
    )
    reason = (
        F.when(F.col("file_name").startswith("~"), LOCK_FILE)
        .when(F.col("agency") == "", OTHER_FILE)
        .when(F.coalesce("service_id", F.lit("")) == "", OTHER_TAB)
    )
    return keyed.withColumn("reject", reason)


def sheet_rejects(classified: DataFrame) -> DataFrame:
    """Files and tabs that were skipped, why, and how many rows they have."""
    return (
        classified.filter(F.col("reject").isNotNull())
        .groupBy("file_name", "sheet", "reject")
        .agg(F.count(F.lit(1)).alias("skipped_rows"))
    )


def sheet_keys(rows: DataFrame, prefix: str = SHEET_PREFIX, extension: str = "xlsx") -> DataFrame:
    """Agency from the file name and service from the tab; files and tabs of other kinds drop out.

    The file name must begin with the prefix, so lock files (~$...) are no sheets; see `classified_sheets`
    for the rules and `sheet_rejects` for what drops out.
    """
    kept = classified_sheets(rows, prefix, extension).filter(F.col("reject").isNull())
    return kept.drop("reject", "file_name")
