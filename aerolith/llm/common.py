"""What several operators of this package need."""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import aerolith
from aerolith.session import scratch_path
from aerolith.sources.files import delete_path

# Beyond this a side of a join is never forced to be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def ship_package(spark: SparkSession) -> None:
    """Give executors this package's code, whatever their Python path is. Once per application."""
    context = spark.sparkContext
    if getattr(context, "_aerolith_shipped", False):
        return
    package = Path(aerolith.__file__).resolve().parent
    folder = Path(SparkFiles.getRootDirectory()) / "code"
    folder.mkdir(parents=True, exist_ok=True)
    archive = folder / "aerolith.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._aerolith_shipped = True


def column(name: str) -> Column:
    """A column by its literal name, also with dots or back-ticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that working columns beside it cannot clash with them."""
    return F.struct(*[column(c) for c in df.columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder and read back from there."""
    path = scratch_path(df.sparkSession, name)
    for noted in _NOTED:
        noted.append(path.rpartition("/")[0])
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_NOTED: list[list[str]] = []


@contextmanager
def noting(folders: list[str]) -> Iterator[None]:
    """Inside the block `stored` notes the folders that it makes."""
    _NOTED.append(folders)
    try:
        yield
    finally:
        _NOTED[:] = [noted for noted in _NOTED if noted is not folders]  # another list may hold the same names


def drop_unread(folders: list[str], reader: DataFrame) -> None:
    """Delete the noted folders, those left out that `reader` takes rows from, and forget them."""
    files = reader.inputFiles() if folders else []
    read = {name for name in folders if any(f"/{name.rpartition('/')[2]}/" in file for file in files)}
    for folder in folders:
        if folder not in read:
            delete_path(reader.sparkSession, folder)
    folders[:] = [folder for folder in folders if folder in read]


# Shuffles go with the write that they served, and Python holds few rows at a time.
SMALL_BATCH = 512
_CLEANUP, _BATCH = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Inside the block, for tables that are `stored` there, disk and Python memory hold what one write needs."""
    before = {name: spark.conf.get(name) for name in (_CLEANUP, _BATCH)}
    batch = int(before[_BATCH])
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_BATCH, str(min(batch, SMALL_BATCH) if batch > 0 else SMALL_BATCH))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def broadcast_if_small(df: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side whose measured size is within the limit; else leave the join to Spark."""
    return F.broadcast(df) if size <= limit else df


def row_bitmaps(rows: DataFrame) -> DataFrame:
    """Row numbers (`row`) as Spark bitmaps of 32,768 rows each: `bucket`, `bits`."""
    return rows.groupBy(F.bitmap_bucket_number("row").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits")
    )


BITMAP_BYTES, PIECE_BYTES, WORD_BYTES = 4096, 256, 8


def _bit_words(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps in pieces of `PIECE_BYTES`, as 64-bit words with the first byte on top: `bucket` (of the piece), `bits`."""
    pieces = BITMAP_BYTES // PIECE_BYTES
    at = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("at")
    words = F.transform(
        F.sequence(F.lit(0), F.lit(PIECE_BYTES // WORD_BYTES - 1)),
        lambda i: F.conv(
            F.hex(F.substring("bits", F.col("at") * PIECE_BYTES + i * WORD_BYTES + 1, F.lit(WORD_BYTES))), 16, -10
        ).cast("long"),
    )
    return bitmaps.select("bucket", "bits", at).select(
        (F.col("bucket") * pieces + F.col("at")).alias("bucket"), words.alias("bits")
    )


def with_bit(staged: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Adds `bit`, 1 for rows that are in the bitmaps. `bitmaps` must be stored.

    One bit per row is broadcast while all of them fit in the limit (500 million rows); beyond that
    rows and bitmaps are joined by shuffle. Words are looked up in place: a whole bitmap as binary would be copied
    for each row.
    """
    position = F.bitmap_bit_position("row")
    byte = F.floor(position / 8)
    piece = F.bitmap_bucket_number("row") * (BITMAP_BYTES // PIECE_BYTES) + F.floor(byte / PIECE_BYTES)
    word = F.get("bits", F.floor(byte % PIECE_BYTES / WORD_BYTES).cast("int"))
    place = (WORD_BYTES - 1 - byte % WORD_BYTES) * 8 + position % 8
    return (
        staged.withColumn("bucket", piece)
        .join(broadcast_if_small(_bit_words(bitmaps), BITMAP_BYTES * bitmaps.count()), "bucket", "left")
        .withColumn("bit", F.coalesce(F.getbit(word, place.cast("int")), F.lit(0)))
        .drop("bucket", "bits")
    )


_DROPS: list[Callable[[], None]] = []


def only_mine(drop: Callable[[], None]) -> None:
    """In a worker: forget what the operator before remembers, so that a reused worker holds the caches of one.

    `drop` empties the caches of the caller.
    """
    while _DROPS and _DROPS[-1] != drop:
        _DROPS.pop()()
    _DROPS[:] = [drop]


class Remembered(dict):
    """Results of a function, the recently used ones kept: about `limit` in two generations."""

    def __init__(self, make: Callable, limit: int, longest: int):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self[key] = value
        return value

    def settle(self) -> None:
        """Between texts: where this generation is full, forget the one before it."""
        if len(self) >= self.limit // 2:
            self.older = dict(self)
            self.clear()
