"""SimHash near-duplicates, found through a table of distances to reference fingerprints.

1. Each text gives a 64-bit fingerprint; equal fingerprints become one row.
2. The pivot table holds, per fingerprint, its Hamming distances to the reference fingerprints
   (`PIVOTS`): zero, and ten patterns inside each of the four 16-bit blocks. The distance to a pattern
   less the distance to zero depends on the bits of that block alone.
3. Two fingerprints that differ in two bits at most agree in two whole blocks, so these differences are
   equal for at least one of the six pairs of blocks: that is the cell in which they meet.
4. By the triangle inequality no coordinate of a linked pair differs by more than the limit. Pairs
   in a cell whose largest coordinate difference exceeds it are discarded; survivors are verified
   by their Hamming distance.
5. A cell with more than `CELL_LIMIT` fingerprints (a large group of near copies) would make too many
   pairs. Its members are measured against closer pivots instead: every fingerprint takes its own 64
   one-bit neighbours as pivots. Two fingerprints within two bits have one at distance one or less in
   common, and any two that share one are within two bits; all that share one are linked
   to the smallest of them. No link between components is lost and the work is linear.

Null text counts as empty, and texts without words have fingerprint zero. Null ids never name a
component unless all ids of it are null. Repeated rows are reported one by one.
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from aerolith.llm.common import broadcast_if_small, column, row_bitmaps, ship_package, stored, whole_row, with_bit
from aerolith.llm.components import roots

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_DISTANCE = 2
BLOCKS = 4
WIDTH = 64 // BLOCKS
PATTERNS_PER_BLOCK = 10
CELL_LIMIT = 64
SHINGLES_AT_ONCE = 1 << 16


def pivots() -> list[int]:
    """Zero, then the patterns of each block: fixed half-filled blocks from a seeded generator."""
    draw = random.Random(20240229)
    found = [0]
    for block in range(BLOCKS):
        for _ in range(PATTERNS_PER_BLOCK):
            bits = draw.sample(range(WIDTH), WIDTH // 2)
            found.append(sum(1 << (block * WIDTH + bit) for bit in bits))
    return found


PIVOTS = pivots()


def fingerprint(text: str | None) -> int:
    """Majority of the XXH64 bits of all three-word shingles, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and space only
    if not words:
        return 0
    together = b" ".join(words)
    size = min(SHINGLE_WORDS, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    hash_of = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for first in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(first, first + SHINGLES_AT_ONCE)
        hashes = np.array(
            [hash_of(together[a:b], HASH_SEED) for a, b in zip(starts[part], ends[part], strict=True)],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(votes * 2 > len(starts), bitorder="little").view("<i8")[0]
    return int(value)


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(text) for text in texts], dtype="int64")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(prints: DataFrame) -> DataFrame:
    """`print` with `to`, its distances to all reference fingerprints."""
    signed = [p - (1 << 64) if p >> 63 else p for p in PIVOTS]
    to = [distance(F.col("print"), F.lit(p).cast("long")).cast("tinyint") for p in signed]
    return prints.select("print", F.array(*to).alias("to"))


def _cells() -> Column:
    """One key per pair of blocks, from the coordinates that depend on these blocks alone."""
    keys = []
    for pair in combinations(range(BLOCKS), 2):
        inside = [
            F.col("to")[1 + block * PATTERNS_PER_BLOCK + i] - F.col("to")[0]
            for block in pair
            for i in range(PATTERNS_PER_BLOCK)
        ]
        keys.append(F.xxhash64(F.lit(pair[0] * BLOCKS + pair[1]), *inside))
    return F.explode(F.array(*keys))


def links(prints: DataFrame) -> DataFrame:
    """Pairs of distinct fingerprints (`a`, `b`) that join everything within the distance limit.

    All pairs of ordinary cells; of crowded cells a spanning set that connects the same fingerprints.
    """
    # Fingerprints are small but become six rows each: they are dealt to all tasks first.
    spread = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "print")
    cells = stored(pivot_table(spread).select(_cells().alias("cell"), "print", "to"), "cells")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stored(cells.join(sizes, "cell"), "shared")
    ordinary = shared.filter(F.col("size") <= CELL_LIMIT)
    left = ordinary.select("cell", F.col("print").alias("a"), F.col("to").alias("to_a"))
    right = ordinary.select("cell", F.col("print").alias("b"), F.col("to").alias("to_b"))
    apart = F.greatest(*[F.abs(F.col("to_a")[i] - F.col("to_b")[i]) for i in range(len(PIVOTS))])
    pairs = (
        left.join(right, (left["cell"] == right["cell"]) & (left["a"] < right["b"]))
        .filter(apart <= MAX_DISTANCE)
        .filter(distance(F.col("a"), F.col("b")) <= MAX_DISTANCE)
        .select("a", "b")
    )
    own_pivots = F.array(
        F.col("print"),
        *[F.col("print").bitwiseXOR(F.lit((1 << i) - ((1 << 64) if i == 63 else 0)).cast("long")) for i in range(64)],
    )
    near = (
        shared.filter(F.col("size") > CELL_LIMIT)
        .select("print")
        .distinct()
        .select("print", F.explode(own_pivots).alias("pivot"))
    )
    # At most 65 fingerprints lie within one bit of a pivot.
    groups = near.groupBy("pivot").agg(F.collect_list("print").alias("prints")).filter(F.size("prints") > 1)
    crowded = groups.select(F.array_min("prints").alias("a"), F.explode("prints").alias("b"))
    return pairs.union(crowded.filter("a < b"))


def components(prints: DataFrame) -> DataFrame:
    """`print`, `root` of fingerprints that have a link, from rows with a `print` column."""
    return roots(links(prints.select("print").distinct())).withColumnRenamed("node", "print")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Two stored tables that meet in `print`, the fingerprint.

    Rows: `doc` (as it was), `row` (its number), `print`. Fingerprints: `print`, `component_id` (the
    smallest key reachable) and `keep_row`, the row that stays: smallest key, then first row.
    """
    ship_package(docs.sparkSession)
    staged = stored(
        docs.select(
            whole_row(docs).alias("doc"),
            F.monotonically_increasing_id().alias("row"),
            fingerprints(column(text)).alias("print"),
        ),
        "fingerprints",
    )
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    groups = (
        staged.select(F.col("doc").getField(key).alias("id"), "row", "print")
        .groupBy("print")
        .agg(F.min(rank).alias("first"))
    )
    groups = stored(groups, "groups")
    linked = stored(components(groups), "roots")
    merged = linked.join(groups, "print").groupBy("root").agg(F.min("first").alias("first_of_all"))
    merged = stored(merged, "merged")
    # A large component is one row here and many on the other side, which therefore stays where it is.
    linked = linked.join(broadcast_if_small(merged, 64 * merged.count()), "root")
    best = (
        groups.join(linked, "print", "left")
        .select("print", F.coalesce("first_of_all", "first").alias("first"))
        .select("print", F.col("first.id").alias("component_id"), F.col("first.row").alias("keep_row"))
    )
    return staged, stored(best, "components")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    staged, best = near_duplicates(docs.select("doc_id", "text"))
    return (
        staged.select(F.col("doc.doc_id").alias("doc_id"), "print")
        .join(best, "print")
        .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns it had."""
    staged, best = near_duplicates(docs)
    stays = stored(row_bitmaps(best.select(F.col("keep_row").alias("row")).distinct()), "stays")
    return with_bit(staged, stays).filter("bit = 1").select("doc.*")
