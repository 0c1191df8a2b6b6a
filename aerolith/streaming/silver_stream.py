"""Silver from newly arrived files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerolith.operators.bronze import malformed
from aerolith.operators.silver import append_new_batches, silver_frame, upsert
from aerolith.session import stage
from aerolith.sources import tables
from aerolith.sources.files import INGEST_MALFORMED, INGEST_ORDER, delete_path
from aerolith.streaming.arrivals import on_arrival


def stream_silver(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    schema: T.StructType,
    *,
    file_format: str | None = None,
    max_year: int | None = None,
    null_safe_key: bool = False,
) -> StreamingQuery:
    """Clean and key the rows of files that arrived since the last call, merge them into Silver, then stop.

    A later arrival replaces what earlier ones brought under its key; within one arrival the last row by file and
    position wins. Each month keeps one row with a null key, as in a batch run. So the table is the one that a single
    batch run over all files gives, where the names of the files sort by arrival. Only the months that an arrival
    touches are rewritten, in one commit; a micro-batch that is repeated after it finds its name and changes
    nothing. An arrival whose rows are all cleaned away writes nothing. Malformed records of CSV
    files are left out; `stream_bronze` keeps them.
    """

    def load(rows: DataFrame, load_id: str) -> None:
        session = rows.sparkSession
        merge_arrival(session, path, rows, load_id, max_year=max_year, null_safe_key=null_safe_key)

    return on_arrival(
        spark, folder, checkpoint, schema, load, file_format=file_format, ingest_order=True
    )


def merge_arrival(
    spark: SparkSession,
    path: str,
    raw: DataFrame,
    load_id: str,
    *,
    max_year: int | None = None,
    null_safe_key: bool = False,
) -> bool:
    """Merge raw rows with their position in the source into Silver under a name; False when that name is known."""
    if tables.is_committed(spark, path, load_id):
        return False
    sound = raw.filter(~malformed(raw.columns)).drop(INGEST_MALFORMED)
    rows = silver_frame(sound, order_by=INGEST_ORDER, max_year=max_year, null_safe_key=null_safe_key)
    staged, folder = stage(rows)
    try:
        if staged.isEmpty():
            return True
        if tables.latest_version(spark, path) is None:
            append_new_batches(spark, path, staged, load_id=load_id)
        else:
            upsert(spark, path, staged, null_matches=True, deduplicated=True, load_id=load_id)
    finally:
        delete_path(spark, folder)
    return True
