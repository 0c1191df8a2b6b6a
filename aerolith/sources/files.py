"""Reading raw files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where a run without an input path looks.
DEFAULT_INPUTS = ("data/Flight_Delay.csv", "data/Flight_Delay.parquet")

# Columns that record the position of a row in its source.
INGEST_FILE = "ingest_file"
INGEST_BLOCK = "ingest_block"
INGEST_ROW = "ingest_row"
INGEST_ORDER = (INGEST_FILE, INGEST_BLOCK, INGEST_ROW)
# The text of a CSV record with too few or too many values or a quote left open; null for all others.
INGEST_MALFORMED = "ingest_malformed"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, for the few metadata calls that are not DataFrame work."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, file_system = hadoop_path(spark, path)
    return file_system.exists(jpath)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 when there is nothing."""
    jpath, file_system = hadoop_path(spark, path)
    return file_system.getContentSummary(jpath).getLength() if file_system.exists(jpath) else 0


def delete_path(spark: SparkSession, path: str) -> None:
    jpath, file_system = hadoop_path(spark, path)
    file_system.delete(jpath, True)


def resolve_input(
    spark: SparkSession, path: str | None = None, candidates: Sequence[str] = DEFAULT_INPUTS
) -> str:
    """An explicit path must exist; without one the first candidate that exists is taken."""
    options = [path] if path is not None else list(candidates)
    for option in options:
        if path_exists(spark, option):
            return option
    raise FileNotFoundError(f"No input found; looked for {', '.join(options)}")


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, malformed: bool = False
) -> DataFrame:
    """CSV with a header line; all columns are text unless a schema is given.

    Types guessed from some rows would turn later values into nulls; the casts of Silver do the typing.
    With `malformed` a column of that name keeps the text of records that do not fit the columns.
    """
    reader = spark.read.options(**csv_options(malformed))
    if malformed:
        schema = with_malformed(schema or spark.read.options(**csv_options()).csv(path).schema)
    return (reader if schema is None else reader.schema(schema)).csv(path)


def csv_options(malformed: bool = False) -> dict[str, str]:
    """How CSV is read, in one go and as a stream."""
    kept = {"columnNameOfCorruptRecord": INGEST_MALFORMED} if malformed else {}
    return {"header": "true", "mode": "PERMISSIVE"} | kept


def with_malformed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(INGEST_MALFORMED, T.StringType())])


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def source_format(path: str) -> str:
    """Format of a source by its suffix."""
    name = path.rstrip("/").lower()
    if name.endswith(".csv"):
        return "csv"
    if name.endswith((".parquet", ".pq")):
        return "parquet"
    raise ValueError(f"Unsupported input format: {path} (expected .csv, .parquet or .pq)")


def scan_source(spark: SparkSession, path: str, *, ingest_order: bool = False) -> DataFrame:
    """Read a source by suffix; `ingest_order` adds the position of each row in the source.

    Of CSV it also keeps the text of malformed records, which a Bronze load puts aside.
    """
    kind = source_format(path)
    df = scan_csv(spark, path, malformed=ingest_order) if kind == "csv" else scan_parquet(spark, path)
    return with_ingest_order(df, kind) if ingest_order else df


def with_ingest_order(scanned: DataFrame, kind: str) -> DataFrame:
    """A scan with the position of each row in the source.

    Parquet reports the row number itself. In CSV the position is the block of the file plus a
    number that grows within the task reading that block; a stream cannot number rows, so there
    `with_ingest_row` does it once a micro-batch is at hand.
    """
    block = F.lit(0).cast("bigint") if kind == "parquet" else F.col("_metadata.file_block_start")
    placed = scanned.select(
        "*",
        F.col("_metadata.file_path").alias(INGEST_FILE),
        block.alias(INGEST_BLOCK),
        *([F.col("_metadata.row_index").alias(INGEST_ROW)] if kind == "parquet" else []),
    )
    return placed if scanned.isStreaming else with_ingest_row(placed)


def with_ingest_row(placed: DataFrame) -> DataFrame:
    """Number the rows of a scan in the order they are read, unless they have their number."""
    if INGEST_ROW in placed.columns:
        return placed
    return placed.withColumn(INGEST_ROW, F.monotonically_increasing_id())
