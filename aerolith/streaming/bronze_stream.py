"""Bronze from newly arrived files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerolith.operators.bronze import append_batches, check_load
from aerolith.streaming.arrivals import on_arrival


def stream_bronze(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    schema: T.StructType,
    *,
    file_format: str | None = None,
    max_year: int | None = None,
) -> StreamingQuery:
    """Append the rows of files that arrived since the last call, then stop.

    All new files form one micro-batch. A file is delivered once, so its rows are added also when the table
    has their month already. The load is named after checkpoint and micro-batch: one that is
    repeated after a failure finds its commit and writes nothing, or replaces what was not committed.
    Rows without a usable year or month fail the stream once the others are written; the next call goes on.
    Malformed records of CSV files go to the table's quarantine.
    """

    def load(rows: DataFrame, load_id: str) -> None:
        result = append_batches(
            rows.sparkSession, rows, path, max_year=max_year, late_rows=True, load_id=load_id
        )
        check_load(result)

    return on_arrival(spark, folder, checkpoint, schema, load, file_format=file_format)
