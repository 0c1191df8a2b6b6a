"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# Beyond these numbers of tasks the driver's book-keeping costs more than larger tasks do.
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SCAN_TASKS = 200_000


def get_spark(app_name: str = "aerolith", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is designed for; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(
    input_bytes: int, cores: int, most: int = MAX_SHUFFLE_PARTITIONS
) -> int:
    """Initial shuffle partitions for an input: about 128 MB each, at least one per core.

    Adaptive execution merges partitions that turn out small but never splits an ordinary
    shuffle, so the initial number has to follow the input. Past 50,000 the partitions grow
    instead (2 GB each at 100 TB); sorts and aggregates spill. `most` raises or lowers that bound.
    """
    wanted = -(-input_bytes // TARGET_PARTITION_BYTES)
    return min(max(cores, wanted), max(cores, most))


def scan_bytes_for(input_bytes: int, most: int = MAX_SCAN_TASKS) -> int:
    """Bytes per scan task: 128 MB, more where that would make over `most` tasks."""
    return max(TARGET_PARTITION_BYTES, -(-input_bytes // most))


_SPARK_DEFAULTS = {"spark.sql.shuffle.partitions": 200, "spark.sql.files.maxPartitionBytes": 128 * 1024 * 1024}
_FITTED: dict[str, dict[str, str]] = {}  # by application: what size_for has set


def size_for(spark: SparkSession, input_bytes: int) -> None:
    """Fit shuffles and scans of the session to the input.

    A setting stays as it is where the user has made it, at start-up or later: where it differs both from Spark's
    default and from what this function set before.
    """
    chosen = spark.sparkContext.getConf()
    fitted = _FITTED.setdefault(spark.sparkContext.applicationId, {})
    sizes = {
        "spark.sql.shuffle.partitions": shuffle_partitions_for(
            input_bytes, spark.sparkContext.defaultParallelism
        ),
        "spark.sql.files.maxPartitionBytes": scan_bytes_for(input_bytes),
    }
    for key, value in sizes.items():
        now = spark.conf.get(key)
        untouched = now == fitted.get(key) or now.removesuffix("b") == str(_SPARK_DEFAULTS[key])
        if untouched and not chosen.contains(key):
            fitted[key] = str(value)
            spark.conf.set(key, str(value))


def scratch_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only on a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith(("local[", "local")) or context.master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
        configured = tempfile.mkdtemp(prefix="aerolith-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that nothing has used before."""
    return f"{scratch_root(spark)}/aerolith-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, read back from shared storage afterwards."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Rows written once as Parquet in the scratch folder and read back, and where they lie.

    Unlike a checkpoint it can be read by column. Drop the folder with `files.delete_path`.
    """
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
