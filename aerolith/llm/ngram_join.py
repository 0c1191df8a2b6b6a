"""Texts that share most of their word n-grams, joined through trees of count vectors.

A text is the set of XXH64 hashes of its five-word shingles; two texts link when their Jaccard similarity reaches
`PERCENT`. Equal sets become one node first. Similar sets share many tokens, so everything below bounds the overlap:

1. A point is a node's number of tokens in each of `GROUPS` groups of hashes. No two sets share more tokens than the sum of
   the smaller counts over all groups, and in a box of points no more than with the box's largest counts.
2. Entry: with tokens in one order for all nodes, two linked sets have `SHARED` in common among their first
   n - ceil(0.8 n) + `SHARED` (all, where they have fewer), since the tokens behind cannot sum to the overlap. A node enters
   the tree of each of these tokens, and pairs that meet in fewer small trees are discarded. The order is by hash, tokens shared by more than `CROWD` nodes last, so that passages shared by many texts
   open no trees. Crowds are counted in the first 1.5 times as many tokens by hash; where too few rare ones are
   left there, all tokens of the node are put in order.
3. A tree with at most `CROWD` points is one leaf. Larger ones are packed by sorting on size band and counts and cutting
   every `CROWD` rows: one box per leaf, its largest counts and range of sizes. Leaves meet leaves of bands within reach; pairs
   of boxes, then pairs of points, are discarded by the summed minima.
4. Survivors are verified on whole sets. Only connection counts: `STAR_ROUNDS` rounds first compare the points of a tree
   with one of them, at first the same in many trees, then another one in each large tree. Pairs that are connected
   already are not asked for again; leaves are packed by class, so that whole leaves drop out. No link between classes is
   lost.

Words are split at ASCII white space after lower-casing A-Z; fewer than five words are one shingle. Null text and texts
without words are empty sets, linked with nothing, each a class of its own. A class is named by its smallest key; null keys
name one only if it has no other. Repeated rows are copies of each other and reported one by one. Very long texts are
sets like others. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from aerolith.llm.common import (
    broadcast_if_small,
    column,
    drop_unread,
    lean,
    noting,
    row_bitmaps,
    ship_package,
    stored,
    with_bit,
)
from aerolith.llm.components import roots

SHINGLE_WORDS = 5
HASH_SEED = 42
PERCENT = 80
GROUPS = 256  # keeps strangers of some thousand words apart; longer ones go on to the whole sets
CROWD = 32
SHARED = 3
KEY_BYTES = 100  # of a key in a broadcast table, at most
MET_BITS = 27  # 16 MB of bits, whatever the corpus
STAR_ROUNDS = 3
BOX_GROUPS = 32  # the groups of a count vector, taken together, in which boxes are kept
MOST = (1 << 15) - 1  # a count of a point in a tree; points with more are left to the whole sets
BAND = 1.12  # two bands up lie all sizes within the reach of 1 / 0.8
OUTLINE = (
    StructType()
    .add("same", BinaryType())
    .add("n", LongType())
    .add("counts", ArrayType(IntegerType()))
    .add("first", ArrayType(LongType()))
)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of all shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and space only
    if not words:
        return np.zeros(0, np.int64)
    together = b" ".join(words)
    size = min(SHINGLE_WORDS, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    hash_of = xxhash.xxh64_intdigest
    hashes = [hash_of(together[a:b], HASH_SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    return np.unique(np.array(hashes, np.uint64).view(np.int64))


def entries_of(n: int) -> int:
    """Among how many first tokens a set of n shares `SHARED` with any set that it links with."""
    return min(n, n - -(-PERCENT * n // 100) + SHARED)


def _overlap(n: Column) -> Column:
    """Tokens that a set of n has in common with any set that it links with, at least."""
    return F.ceil(n * PERCENT / F.lit(100)).cast("long")


def _entries(n: Column) -> Column:
    return F.least(n, n - _overlap(n) + SHARED)


def _region(n: Column) -> Column:
    return F.least(n, F.floor(_entries(n) * 3 / F.lit(2)).cast("long"))


@F.pandas_udf(OUTLINE)
def outlines(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        hashes = shingles(text)
        n = len(hashes)
        counts = np.bincount(hashes & (GROUPS - 1), minlength=GROUPS).astype(np.int32)
        rows.append((xxhash.xxh3_128_digest(hashes.tobytes()), n, counts, hashes[: min(n, entries_of(n) * 3 // 2)]))
    return pd.DataFrame(rows, columns=["same", "n", "counts", "first"])


@F.pandas_udf(ArrayType(LongType()))
def shingle_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(text) for text in texts])


def _fits(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _reaches(common: Column, sizes: Column) -> Column:
    """Whether so many common tokens, of so many in both sets together, make a link."""
    return (100 + PERCENT) * common >= PERCENT * sizes


def _least_sum(a: str, b: str) -> Column:
    smaller = F.zip_with(a, b, lambda x, y: F.least(x, y))
    return F.aggregate(smaller, F.lit(0).cast("long"), lambda total, x: total + x)


@F.pandas_udf(ArrayType(ArrayType(LongType())))
def _point_pairs(
    nodes_a: pd.Series, sizes_a: pd.Series, roots_a: pd.Series, counts_a: pd.Series,
    nodes_b: pd.Series, sizes_b: pd.Series, roots_b: pd.Series, counts_b: pd.Series,
) -> pd.Series:
    """Pairs of points of two leaves that the summed minima allow and that are not connected yet."""
    found = []
    for na, sa, ra, ca, nb, sb, rb, cb in zip(
        nodes_a, sizes_a, roots_a, counts_a, nodes_b, sizes_b, roots_b, counts_b, strict=True
    ):
        ca, cb = np.reshape(ca, (len(na), -1)), np.reshape(cb, (len(nb), -1))
        common = np.array([np.minimum(point, cb).sum(axis=1, dtype=np.int64) for point in ca])
        common[(ca >= MOST).any(axis=1)] = common[:, (cb >= MOST).any(axis=1)] = 1 << 40
        small, large = np.minimum(sa[:, None], sb[None, :]), np.maximum(sa[:, None], sb[None, :])
        near = ((100 + PERCENT) * common >= PERCENT * (small + large)) & (100 * small >= PERCENT * large)
        at = np.argwhere(near & (ra[:, None] != rb[None, :]))
        found.append([sorted((int(na[i]), int(nb[j]))) for i, j in at])
    return pd.Series(found)


class _Join:
    """The join over one staged table: `row`, `text`, `n`, `counts`, `first`."""

    def __init__(self, staged: DataFrame):
        self.staged = staged

    def some(self, rows: DataFrame, *columns: str) -> DataFrame:
        """`node`, `n` and these columns of the rows listed in `row`. Other rows are not moved."""
        wanted = stored(row_bitmaps(rows.select("row").distinct()), "wanted")
        found = with_bit(self.staged.select("row", "n", *columns), wanted).filter("bit = 1")
        return found.select(F.col("row").alias("node"), "n", *columns)

    def sets(self, rows: DataFrame) -> DataFrame:
        """`node`, `n`, `tokens` of the rows listed in `row`, from their texts."""
        return self.some(rows, "text").select("node", "n", shingle_sets("text").alias("tokens"))

    def postings(self, nodes: DataFrame) -> DataFrame:
        """Stored `token`, `node`, `n`, `size`: the trees with more than one point and who enters them."""
        early = nodes.select("node", "n", F.explode("first").alias("token"))
        shared = early.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1")
        shared = stored(shared, "shared")
        crowds = shared.filter(F.col("size") > CROWD).select("token")
        crowds = broadcast_if_small(crowds, KEY_BYTES * crowds.count())
        short = (
            early.join(crowds, "token", "left_semi")
            .groupBy("node", "n")
            .agg(F.count("*").alias("common"))
            .filter(_region(F.col("n")) - F.col("common") < _entries(F.col("n")))
        )
        short = stored(short.select("node"), "short")
        entered = (
            self.sets(short.select(F.col("node").alias("row")))
            .select("node", "n", F.explode_outer("tokens").alias("token"))  # else the function runs below the filter
            .join(crowds.withColumn("common", F.lit(True)), "token", "left")
            .withColumn("common", F.coalesce("common", F.lit(False)))
            .groupBy("node", "n")
            .agg(F.collect_list(F.struct("common", "token")).alias("all"))
            .select("node", "n", F.explode(F.slice(F.sort_array("all"), 1, _entries(F.col("n")).cast("int"))).alias("at"))
            .select("at.token", "node", "n", "at.common")
        )
        entered = stored(entered, "entered")
        met = (
            shared.filter(F.col("size") <= CROWD)
            .select("token")
            .union(entered.filter("not common").select("token"))
        )
        # A bit set by chance lets a token in that nobody else has, the more of them the larger the corpus: its tree
        # has one point and goes here, before anything else reads it.
        place = F.col("token").bitwiseAND((1 << MET_BITS) - 1)
        bits = stored(row_bitmaps(met.select(place.alias("row")).distinct()), "met")
        others = (
            with_bit(early.withColumn("row", place), bits)
            .filter("bit = 1")
            .join(crowds, "token", "left_anti")
            .join(broadcast_if_small(short, KEY_BYTES * short.count()), "node", "left_anti")
            .select("token", "node", "n")
        )
        entering = stored(others.union(entered.select("token", "node", "n")), "entering")
        sizes = entering.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1")
        return stored(entering.join(sizes, "token"), "postings")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Stored links among pairs (`a`, `b`) of fitting sizes: by points first, then by whole sets."""
        pairs = stored(pairs, "pairs")  # what finding them shuffled is gone before points and sets move
        points = self.some(pairs.select(F.col("a").alias("row")).union(pairs.select("b")), "counts")

        def point(side: str) -> DataFrame:
            return points.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "counts")])

        near = (
            pairs.join(point("a"), "a")
            .join(point("b"), "b")
            .filter(_reaches(_least_sum("counts_a", "counts_b"), F.col("n_a") + F.col("n_b")))
            .select("a", "b")
        )
        near = stored(near, "near")
        members = self.sets(near.select(F.col("a").alias("row")).union(near.select("b")))
        members = stored(members, "members")

        def of(side: str) -> DataFrame:
            return members.select(F.col("node").alias(side), F.col("tokens").alias(f"tokens_{side}"))

        common = F.size(F.array_intersect("tokens_a", "tokens_b"))
        links = near.join(of("a"), "a").join(of("b"), "b").filter(
            _reaches(common, F.size("tokens_a") + F.size("tokens_b"))
        )
        return stored(links.select("a", "b"), "links")

    def boxed_pairs(self, crowded: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs of large trees, which these nodes are in: packed into leaves, met by boxes, then by points."""
        width = GROUPS // BOX_GROUPS
        together = F.transform(
            F.sequence(F.lit(0), F.lit(BOX_GROUPS - 1)),
            lambda i: F.aggregate(F.slice("counts", i * width + 1, width), F.lit(0), lambda total, x: total + x),
        )
        fine = F.transform("counts", lambda c: F.least(c, F.lit(MOST)).cast("smallint"))
        points = self.some(nodes.select(F.col("node").alias("row")), "counts")
        counts = points.select("node", together.alias("counts"), fine.alias("fine"))
        band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(BAND)))
        points = crowded.join(counts, "node").withColumn("band", band)
        order = ["token", "band", "root", *[F.col("counts")[i] for i in range(BOX_GROUPS)], "node"]
        packed = points.repartitionByRange(*order).sortWithinPartitions(*order)
        leaf = F.floor(F.monotonically_increasing_id() / CROWD)
        packed = stored(packed.select("token", "band", leaf.alias("leaf"), "node", "n", "root", "counts", "fine"), "packed")
        leaves = packed.groupBy("token", "band", "leaf").agg(
            F.array(*[F.max(F.col("counts")[i]) for i in range(BOX_GROUPS)]).alias("box"),
            F.min("n").alias("least"),
            F.max("n").alias("most"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.collect_list(F.struct("node", "n", "root", "fine")).alias("points"),
        )
        leaves = stored(leaves, "leaves")
        size = packed.count() * (2 * GROUPS + KEY_BYTES)
        boxes = ("leaf", "box", "least", "most", "low", "high")

        def side(name: str, band: Column) -> DataFrame:
            return leaves.select("token", band.alias("band"), F.col("band").alias(f"band_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in boxes])

        reach = F.explode(F.array(*[F.col("band") + i for i in range(3)]))
        once = (F.col("band_a") < F.col("band_b")) | (F.col("leaf_a") <= F.col("leaf_b"))
        apart = F.least("low_a", "low_b") < F.greatest("high_a", "high_b")
        sizes = (100 * F.col("most_a") >= PERCENT * F.col("least_b")) & (100 * F.col("most_b") >= PERCENT * F.col("least_a"))
        meeting = (
            side("a", reach)
            .join(side("b", F.col("band")), ["token", "band"])
            .filter(once & apart & sizes)
            .filter(_reaches(_least_sum("box_a", "box_b"), F.col("least_a") + F.col("least_b")))
            .select("token", "band_a", "leaf_a", "band_b", "leaf_b")
        )
        # Few bytes, much to compare: dealt to all tasks.
        tasks = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        meeting = meeting.repartition(tasks, "token", "leaf_a", "leaf_b")
        for name in "ab":
            content = leaves.select(
                "token",
                F.col("band").alias(f"band_{name}"),
                F.col("leaf").alias(f"leaf_{name}"),
                *[F.col(f"points.{f}").alias(f"{f}_{name}") for f in ("node", "n", "root")],
                F.flatten("points.fine").alias(f"counts_{name}"),
            )
            meeting = meeting.join(broadcast_if_small(content, size), ["token", f"band_{name}", f"leaf_{name}"])
        near = _point_pairs(*[f"{f}_{name}" for name in "ab" for f in ("node", "n", "root", "counts")])
        return (
            meeting.select(F.explode_outer(near).alias("pair"))
            .filter(F.col("pair").isNotNull())
            .select(F.col("pair")[0].alias("a"), F.col("pair")[1].alias("b"))
        )

    def classes(self, nodes: DataFrame) -> DataFrame:
        """`node`, `root` of the nodes that have a link. Working tables go as soon as nothing reads them any more."""
        made: list[str] = []
        with noting(made):
            postings, links, tree = self.postings(nodes), None, None
        drop_unread(made, postings)
        for turn in range(STAR_ROUNDS + 1):
            rooted = postings.withColumn("root", F.col("node"))
            if tree is not None:
                rooted = postings.join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
            last = turn == STAR_ROUNDS
            if turn or last:
                now = rooted.filter(F.col("size") > CROWD)
                mixed = now.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                mixed = mixed.filter(F.col("low") < F.col("high")).select("token")
                with noting(made):
                    now = stored(now.join(mixed, "token"), "open")
                if not last and now.isEmpty():
                    continue
            else:  # every point is a class of its own
                now = rooted.filter(F.col("size") > 2)
            with noting(made):
                small = rooted.filter(F.col("size") <= CROWD)
                found = self.verified(self._all_pairs(small, now) if last else _star_pairs(now, turn))
                links = found if links is None else links.union(found)
                tree = stored(roots(links), "roots")
            kept = tree.select("node") if last else postings.select("node").union(links.select("a")).union(tree.select("node"))
            drop_unread(made, kept)
        return tree

    def _all_pairs(self, small: DataFrame, large: DataFrame) -> DataFrame:
        """Pairs of small trees and of large ones that are open still."""
        # Points of large trees may share tokens there as well: their pairs are not judged by the number of small trees.
        nodes = stored(large.select("node").distinct(), "busy")
        busy = broadcast_if_small(nodes.withColumn("busy", F.lit(True)), KEY_BYTES * nodes.count())
        leaf = small.join(busy, "node", "left")
        left, right = (
            leaf.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "root", "busy")]) for side in "ab"
        )
        apart = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
        met = left.join(right, "token").filter(apart & _fits(F.col("n_a"), F.col("n_b")))
        enough = F.least(F.lit(SHARED), _overlap(F.greatest("n_a", "n_b")))
        few = (
            met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b")
            .agg(F.count("*").alias("trees"), F.max(F.coalesce("busy_a", "busy_b", F.lit(False))).alias("busy"))
            .filter(F.col("busy") | (F.col("trees") >= enough))
            .select("a", "b")
        )
        return few.union(self.boxed_pairs(large.drop("size"), nodes)).distinct()


def _star_pairs(now: DataFrame, turn: int) -> DataFrame:
    """Each point with one of its tree, another one in each turn. No pair is lost for good here; strangers are left out."""
    key = F.xxhash64("node", "token", F.lit(turn)) if turn else F.xxhash64("node")
    drawn = F.struct(key, *[F.col(c).alias(c) for c in ("node", "n", "root")])
    hubs = now.groupBy("token").agg(F.min(drawn).alias("hub"))
    met = now.join(hubs, "token").filter((F.col("root") != F.col("hub.root")) & _fits(F.col("n"), F.col("hub.n")))
    pairs = met.groupBy(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
    return pairs.agg(F.count("*").alias("trees")).filter(F.col("trees") >= (1 if turn else SHARED)).select("a", "b")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two stored tables that meet in `same`. Rows: `id`, `row`, `text`, `same`, `n`, `counts`, `first`. Sets with
    tokens: `same`, `node` (the row of its first text) and `component_id`."""
    spark, made = docs.sparkSession, []
    ship_package(spark)
    with lean(spark), noting(made):
        staged, classes = _joined(docs, key, text)
    drop_unread(made, staged.select("row").union(classes.select("node")))
    return staged, classes


def _joined(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    outlined = docs.select(
        column(key).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        column(text).alias("text"),
        outlines(column(text)).alias("outline"),
    )
    staged = stored(outlined.select("id", "row", "text", "outline.*"), "outlines")
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    sets = staged.filter("n > 0").groupBy("same").agg(F.min(rank).alias("best"))
    sets = stored(sets.withColumn("node", F.col("best.row")), "sets")
    firsts = stored(row_bitmaps(sets.select(F.col("node").alias("row"))), "firsts")
    nodes = with_bit(staged.select("row", "n", "first"), firsts).filter("bit = 1")
    tree = _Join(staged).classes(nodes.select(F.col("row").alias("node"), "n", "first"))
    merged = tree.join(sets, "node").groupBy("root").agg(F.min("best").alias("best_of_all"))
    merged = stored(merged, "merged")
    # A large class is one row here and many on the other side, which therefore stays where it is.
    named = tree.join(broadcast_if_small(merged, 64 * merged.count()), "root").select("node", "best_of_all")
    classes = sets.join(named, "node", "left").select(
        "same", "node", F.coalesce("best_of_all", "best").getField("id").alias("component_id")
    )
    return staged, stored(classes, "classes")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    staged, classes = join(docs.select("doc_id", "text"))
    return (
        staged.select("id", "same", "n")
        .join(classes.select("same", "component_id"), "same", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )
