"""Benchmark decontamination with a positional inverted index. DataFrame functions only.

1. The words of all benchmark items are the terms. The index has one posting (row, position, term) for
   each occurrence of a term in the documents, written to the shared folder; other words cannot be
   part of a match.
2. A window is `WINDOW` consecutive words of an item (the whole item, if shorter). The lists of its
   terms are intersected from the rarest on: each posting of its rarest term proposes an alignment
   of item and document, and the second rarest term must have a posting at the offset this calls for.
3. Alignments that survive are checked against the lists of all their other terms. A run of
   matching offsets as long as a window is an exact phrase match; its words are hit.

`proximity` answers the looser question: where do the two rarest words of a window stand near
each other?

Terms and windows depend on the benchmark alone; they are broadcast only while their measured size is
within the limit, and otherwise joined by shuffle. Joins on documents are keyed by row and
position, so one document or one common passage spreads over many tasks.

Long items take rows in proportion to their words: a place is copied once per window it lies in.
Null or wordless texts have no words, no hits and no items. Items without words or without id match
nothing that is listed: a null item_id still marks words as hit but is not counted. Repeated item ids count
once; repeated documents are reported one by one. Empty tables give empty results, an empty benchmark
leaves every document clean.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import broadcast_if_small, column, row_bitmaps, stored, with_bit

WINDOW = 10
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing A-Z
BYTES_PER_TERM = 128  # of a broadcast term or window, with room to spare


def plain_words(text: Column) -> Column:
    """The words of a text, lower-cased in A-Z only, with one space between them."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lowered, BETWEEN_WORDS, " "))


def split_words(plain: Column) -> Column:
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


class PositionalIndex:
    """Postings of the benchmark's terms in the documents, and the windows to look for."""

    def __init__(
        self,
        docs: DataFrame,
        items: DataFrame,
        text: str = "text",
        item_id: str = "item_id",
        item_text: str = "text",
        keep: Sequence[str] | None = None,
    ):
        kept = docs.columns if keep is None else keep
        plain = plain_words(column(text))
        self.rows = stored(
            docs.select(
                F.struct(*[column(c) for c in kept]).alias("doc"),
                F.monotonically_increasing_id().alias("row"),
                plain.alias("plain"),
                F.size(split_words(plain)).cast("long").alias("n_words"),
            ),
            "rows",
        )
        asked = stored(
            items.select(
                F.monotonically_increasing_id().alias("item"),
                column(item_id).cast("string").alias("item_id"),
                split_words(plain_words(column(item_text))).alias("words"),
            ),
            "items",
        )
        self.item_ids = asked.select("item", "item_id")
        spelled = asked.select("item", F.size("words").alias("length"), F.posexplode("words").alias("at", "word"))
        terms = spelled.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term"))
        terms = stored(terms, "terms")
        self.term_bytes = terms.count() * BYTES_PER_TERM
        words = split_words(F.col("plain"))
        self.postings = stored(
            self.rows.select("row", F.posexplode(words).alias("pos", "word"))
            .join(broadcast_if_small(terms, self.term_bytes), "word")
            .select("row", "pos", "term"),
            "postings",
        )
        lengths = self.postings.groupBy("term").agg(F.count("*").alias("postings"))
        # Terms of items by offset; `postings` is null for a term that no document has.
        self.item_terms = stored(
            spelled.join(terms, "word").join(lengths, "term", "left").drop("word"), "item_terms"
        )
        self.anchors = stored(self._anchors(), "anchors")
        self.anchor_bytes = self.anchors.count() * BYTES_PER_TERM

    def _anchors(self) -> DataFrame:
        """The two rarest places of every window that can occur, each pair once."""
        size = F.least("length", F.lit(WINDOW))
        first = F.greatest(F.lit(0), F.col("at") - size + 1)  # of the windows that a place lies in
        last = F.least("at", F.col("length") - size)
        place = F.struct("at", "term", "postings")
        windows = (
            self.item_terms.select("item", "at", "term", "postings", F.explode(F.sequence(first, last)).alias("start"))
            .groupBy("item", "start")
            .agg(F.sort_array(F.collect_list(place)).alias("places"))  # no more than WINDOW
            .filter(~F.exists("places", lambda p: p["postings"].isNull()))
        )
        by_rarity = F.sort_array(
            F.transform("places", lambda p: F.struct(p["postings"], p["at"], p["term"]))
        )
        return (
            windows.select("item", by_rarity.alias("rare"))
            .select(
                "item",
                F.col("rare")[0]["term"].alias("term"),
                F.col("rare")[0]["at"].alias("at"),
                F.get("rare", F.lit(1))["term"].alias("next_term"),
                (F.get("rare", F.lit(1))["at"] - F.col("rare")[0]["at"]).alias("step"),
            )
            .distinct()
        )

    def _rarest(self) -> DataFrame:
        """Postings of rarest terms with what they propose."""
        return self.postings.join(broadcast_if_small(self.anchors, self.anchor_bytes), "term")

    def _second_lists(self) -> DataFrame:
        wanted = self.anchors.select(F.col("next_term").alias("term")).distinct()
        return self.postings.join(broadcast_if_small(wanted, self.anchor_bytes), "term", "left_semi")

    def alignments(self) -> DataFrame:
        """Alignments (row, item, shift, at) on which the two rarest lists of a window agree."""
        proposed = self._rarest().select(
            "row", "item", "at", (F.col("pos") - F.col("at")).alias("shift"), "next_term",
            (F.col("pos") + F.col("step")).alias("next_pos"),
        )
        second = self._second_lists().select(
            "row", F.col("pos").alias("next_pos"), F.col("term").alias("next_term")
        )
        agreed = proposed.join(second, ["row", "next_pos", "next_term"])
        alone = proposed.filter("next_term IS NULL")  # items of one word
        picked = ("row", "item", "shift", "at")
        return agreed.select(*picked).union(alone.select(*picked)).distinct()

    def phrases(self) -> DataFrame:
        """Maximal runs of hit words: row, item, and the first and last position."""
        found = stored(self.alignments(), "alignments")
        places = self.item_terms.select("item", F.col("at").alias("place"), "term", "length")
        expected = (
            found.withColumn("place", F.explode(F.sequence(F.col("at") - (WINDOW - 1), F.col("at") + (WINDOW - 1))))
            .join(broadcast_if_small(places, self.item_terms.count() * BYTES_PER_TERM), ["item", "place"])
            .select("row", "item", "shift", "place", "term", "length", (F.col("shift") + F.col("place")).alias("pos"))
            .distinct()
        )
        rows = stored(found.select("row").distinct(), "found")
        nearby = self.postings.join(broadcast_if_small(rows, 32 * rows.count()), "row", "left_semi")
        matched = expected.join(nearby, ["row", "pos", "term"])
        alignment = ("row", "item", "shift", "length")
        # A partition is one alignment: no more rows than the item has words.
        in_order = F.row_number().over(Window.partitionBy(*alignment).orderBy("place"))
        runs = (
            matched.withColumn("run", F.col("place") - in_order)
            .groupBy(*alignment, "run")
            .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        )
        size = F.least("length", F.lit(WINDOW))
        return runs.filter(F.col("last") - F.col("first") + 1 >= size).select("row", "item", "first", "last")

    def proximity(self, within: int) -> DataFrame:
        """Where the two rarest words of a window stand at most `within` words apart, in any order.

        Columns: row, item, at (place of the rarest word in the item), pos and near_pos.
        """
        cell = F.floor(F.col("pos") / within).cast("long")
        left = self._rarest().select(
            "row", "item", "at", "pos", "next_term",
            F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"),
        )
        right = self._second_lists().select(
            "row", F.col("term").alias("next_term"), F.col("pos").alias("near_pos"), cell.alias("cell")
        )
        return (
            left.join(right, ["row", "next_term", "cell"])
            .filter((F.abs(F.col("pos") - F.col("near_pos")) <= within) & (F.col("pos") != F.col("near_pos")))
            .select("row", "item", "at", "pos", "near_pos")
            .distinct()
        )


def hits(index: PositionalIndex) -> DataFrame:
    """Per contaminated row: n_hit, n_items and items_sha256."""
    phrases = stored(index.phrases(), "phrases")
    words = (
        phrases.select("row", F.explode(F.sequence("first", "last")).alias("pos"))
        .distinct()
        .groupBy("row")
        .agg(F.count("*").alias("n_hit"))
    )
    items = (
        phrases.select("row", "item")
        .distinct()
        .join(index.item_ids, "item")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
        .select(
            "row",
            F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
        )
    )
    return words.join(items, "row")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    index = PositionalIndex(docs, items, keep=["doc_id"])
    zero = F.lit(0).cast("long")
    return (
        index.rows.select(F.col("doc.doc_id").alias("doc_id"), "row", "n_words")
        .join(hits(index), "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce("n_items", zero).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows with no hit word, with the columns they had."""
    index = PositionalIndex(docs, items)
    dirty = stored(row_bitmaps(index.phrases().select("row").distinct()), "dirty")
    return with_bit(index.rows.select("doc", "row"), dirty).filter("bit = 0").select("doc.*")
