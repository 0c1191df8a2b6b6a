"""Exact deduplication by exchanging Golomb-coded fingerprints.

1. Rows are written once with a row number and a 64-bit hash, so every later pass sees the same rows.
2. Each task cuts the hashes of a stretch of rows to the bits that the row count calls for and sends
   every owner (a range of hashes) one message: its distinct values, sorted, as Golomb-Rice coded
   gaps. Values that repeat inside the stretch are marked by the sender itself, so an owner sees
   each value at most once per sender, however many copies there are.
3. An owner answers each message with a bitmap: one bit per value that another sender has too.
4. Only rows with a marked value (suspects) are shuffled, with their texts, and grouped by the
   bytes of the text. All other rows are known to be unique and never leave their task.

Null text counts as empty. Of equal texts the row with the largest doc_id stays (a null id ranks
lowest); where rows repeat with the same id and text, exactly one of them stays. An empty table gives
an empty result. Further columns of any name are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import (
    column,
    row_bitmaps,
    ship_package,
    stored,
    whole_row,
    with_bit,
)

ROWS_PER_MESSAGE = 1 << 16
ROWS_PER_OWNER = 1 << 18
SPARE_BITS = 12  # one unique row in about 4,096 becomes a suspect by chance
MESSAGE = "sender long, owner long, size int, rice int, coded binary, members array<long>, slots array<int>"
REPLY = "sender long, owner long, marked binary"


def rice_encode(values: np.ndarray, rice: int) -> bytes:
    """Sorted distinct values as gaps: all unary quotients, then all remainders of `rice` bits."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotients = (gaps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    shifts = np.arange(rice, dtype=np.uint64)
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return np.packbits(np.concatenate([unary, remainders.ravel()])).tobytes()


def rice_decode(coded: bytes, size: int, rice: int) -> np.ndarray:
    """The values that `rice_encode` was given."""
    bits = np.unpackbits(np.frombuffer(coded, np.uint8))
    ends = np.flatnonzero(bits)[:size]
    quotients = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    start = int(ends[-1]) + 1 if size else 0
    remainders = bits[start : start + size * rice].reshape(size, rice).astype(np.uint64)
    weights = np.uint64(1) << np.arange(rice, dtype=np.uint64)
    gaps = (quotients << np.uint64(rice)) + (remainders * weights).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def best_rice(values: np.ndarray) -> int:
    """Remainder bits near the optimum for the mean gap."""
    mean = float(values[-1]) / len(values) if len(values) else 1.0
    return max(0, int(np.floor(np.log2(max(mean * 0.69, 1.0)))))


def _messages(owners: int, bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            members = np.concatenate([m for m, _ in held])
            prints = np.concatenate([p for _, p in held]).view(np.uint64)
            held.clear()
            order = np.argsort(prints, kind="stable")
            members, prints = members[order], prints[order]
            width = np.uint64(-(-(1 << bits) // owners))
            cuts = np.searchsorted(prints // width, np.arange(owners + 1))
            rows = []
            for owner in np.flatnonzero(np.diff(cuts)):
                mine = slice(cuts[owner], cuts[owner + 1])
                values, slots = np.unique(prints[mine], return_inverse=True)
                values = values - np.uint64(owner) * width
                rice = best_rice(values)
                rows.append(
                    {
                        "sender": int(members.min()),
                        "owner": int(owner),
                        "size": len(values),
                        "rice": rice,
                        "coded": rice_encode(values, rice),
                        "members": members[mine],
                        "slots": slots.astype(np.int32),
                    }
                )
            return pa.RecordBatch.from_pylist(
                rows,
                schema=pa.schema(
                    [
                        ("sender", pa.int64()),
                        ("owner", pa.int64()),
                        ("size", pa.int32()),
                        ("rice", pa.int32()),
                        ("coded", pa.binary()),
                        ("members", pa.list_(pa.int64())),
                        ("slots", pa.list_(pa.int32())),
                    ]
                ),
            )

        count = 0
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                count += batch.num_rows
            if count >= ROWS_PER_MESSAGE:
                yield flush()
                count = 0
        if held:
            yield flush()

    return send


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One owner: for each sender, which of its values another sender has too."""
    messages = [
        rice_decode(coded, size, rice)
        for coded, size, rice in zip(
            table["coded"].to_pylist(), table["size"].to_pylist(), table["rice"].to_pylist(), strict=True
        )
    ]
    together = np.concatenate(messages)
    _, inverse, counts = np.unique(together, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    cuts = np.cumsum([0, *map(len, messages)])
    marked = [
        np.packbits(shared[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    return pa.table(
        {
            "sender": table["sender"],
            "owner": table["owner"],
            "marked": pa.array(marked, pa.binary()),
        }
    )


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row numbers whose value is marked by the owner or repeats at the sender."""
    for batch in batches:
        found = []
        for members, slots, marked in zip(
            batch.column("members"), batch.column("slots"), batch.column("marked"), strict=True
        ):
            slots = slots.values.to_numpy()
            shared = np.unpackbits(np.frombuffer(marked.as_py(), np.uint8)).astype(bool)
            repeated = np.bincount(slots) > 1
            found.append(members.values.to_numpy()[shared[slots] | repeated[slots]])
        rows = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64())], ["row"])


def marked_rows(rows: DataFrame) -> DataFrame:
    """Rows (`row`, `print`) that may have a copy, as Spark bitmaps: `bucket`, `bits`."""
    total = rows.count()
    bits = min(63, max(1, total.bit_length()) + SPARE_BITS)
    owners = max(1, -(-total // ROWS_PER_OWNER))
    outbox = stored(
        rows.select("row", F.shiftrightunsigned("print", 64 - bits).alias("print")).mapInArrow(
            _messages(owners, bits), MESSAGE
        ),
        "outbox",
    )
    replies = (
        outbox.select("sender", "owner", "size", "rice", "coded")
        .groupBy("owner")
        .applyInArrow(_answer, REPLY)
    )
    suspects = (
        outbox.select("sender", "owner", "members", "slots")
        .join(replies, ["sender", "owner"])
        .mapInArrow(_suspects, "row long")
    )
    return row_bitmaps(suspects)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the group of equal texts it belongs to.

    Columns: `doc` (the row as it was), `text_sha256`, `keep_id` (key of the row that stays),
    `group_size`, `kept`.
    """
    ship_package(docs.sparkSession)
    staged = stored(
        docs.select(
            whole_row(docs).alias("doc"),
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64(F.coalesce(column(text), F.lit(""))).alias("print"),
        ),
        "staged",
    )
    marks = stored(marked_rows(staged.select("row", "print")), "marks")
    rows = with_bit(staged, marks).select(
        "doc", "row", "bit", F.coalesce(F.col("doc").getField(text), F.lit("")).alias("body")
    )
    id_of = F.col("doc").getField(key)
    suspects = rows.filter("bit = 1")
    groups = (
        suspects.groupBy("body")
        .agg(
            F.max(F.struct(id_of.isNotNull(), id_of.alias("id"), (-F.col("row")).alias("last"))).alias("best"),
            F.count("*").alias("group_size"),
        )
        .select(
            F.sha2("body", 256).alias("text_sha256"),
            F.col("best.id").alias("keep_id"),
            (-F.col("best.last")).alias("keep_row"),
            "group_size",
        )
    )
    checked = (
        suspects.select("doc", "row", F.sha2("body", 256).alias("text_sha256"))
        .join(groups, "text_sha256")
        .select(
            "doc", "text_sha256", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
        )
    )
    alone = rows.filter("bit = 0").select(
        "doc",
        F.sha2("body", 256).alias("text_sha256"),
        id_of.alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return alone.unionByName(checked)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    # Only what the report needs is staged.
    marked = exact_duplicates(docs.select("doc_id", "text"))
    return marked.select(
        F.col("doc.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns they had."""
    return exact_duplicates(docs).filter("kept").select("doc.*")
