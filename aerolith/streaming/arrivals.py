"""Files that keep arriving in a folder, as a stream."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerolith.sources.files import (
    csv_options,
    source_format,
    with_ingest_order,
    with_ingest_row,
    with_malformed,
)


def on_arrival(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    schema: T.StructType,
    load: Callable[[DataFrame, str], None],
    *,
    file_format: str | None = None,
    ingest_order: bool = False,
) -> StreamingQuery:
    """Hand the rows of files that arrived since the last call to `load`, then stop.

    All new files form one micro-batch. `load` also gets a name made from checkpoint and micro-batch, by which it
    can tell that a micro-batch is repeated after a failure. `ingest_order` adds the position of each row. Of
    CSV the text of malformed records is kept (`files.INGEST_MALFORMED`).
    """
    kind = file_format or source_format(folder)
    reader = spark.readStream.format(kind)
    if kind == "csv":
        reader = reader.options(**csv_options(malformed=True)).schema(with_malformed(schema))
    else:
        reader = reader.schema(schema)
    arrived = reader.load(folder)
    if ingest_order:
        arrived = with_ingest_order(arrived, kind)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def take(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            load(with_ingest_row(rows) if ingest_order else rows, f"s{stream}-{batch_id}")

    return (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
