"""Hard negatives for anchors, by bounds along spanning trees of anchors.

An anchor's positives are its best rows of the same label; the negatives of a positive are the best
rows of other labels whose scores lie in a window below the positive's. Scores are inner products
of whole numbers and exact.

Anchors near each other share a tree, a minimum spanning tree by distance. The scores of all rows at
its root are computed; from an anchor to the next, a row's score moves by at most the length of
the edge times the row's norm. So every row has an interval at every anchor, and only rows whose
interval overlaps the window, and could still be among the best of their block, are scored
again, which makes their interval a point from which the anchor's own children go on.

The anchors are the stated query set against all rows: trees (anchors dealt by range of a locality
code) meet blocks of rows (dealt by hash), a pair at a time, both of bounded size. A pair of blocks
reports the best it has, and the best of all blocks are the result. Nothing is capped but the lists
asked for, and no table is broadcast or collected.

Rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part. Rows that
repeat entirely are one row; rows that share an id and differ are rows of their own, told apart
by their contents. Vectors of different lengths are not compared; empty ones score 0 with each other.
Ties go to the smaller id. An anchor without positives, or a positive without negatives, has no
rows. A score that a long cannot hold stops the job. An empty table gives no rows; other columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhaul.llm.common import Scratch, reachable

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's score lies.
LOWEST, HIGHEST = 30, 90
SEED = 61
#: Anchors of a tree and rows of a block at most, on average, and bytes of a block's vectors.
TREE_ANCHORS, BLOCK_ROWS, BLOCK_BYTES = 1024, 100_000, 32 * 1024**2
#: So many blocks, and trees, there are at least where rows, and anchors, allow.
LEAST_BLOCKS, LEAST_ROWS = 32, 512
LEAST_TREES, LEAST_ANCHORS = 4, 64

_KEY = ["anchor_id", "a1", "a2"]
_KEYS = "anchor_id long, a1 long, a2 long"


def vectors_of(lists: pa.Array) -> np.ndarray:
    """A matrix of whole numbers from lists of one length."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


class Scorer:
    """Exact inner products of a block's vectors with others, and bounds of them."""

    def __init__(self, block: np.ndarray):
        self.whole = block
        self.largest = float(np.abs(block.astype(np.float64)).max(initial=0))
        self.floats = block.astype(np.float64)
        # A little above the true norms, so that rounding never narrows an interval.
        self.norms = np.sqrt((self.floats**2).sum(axis=1)) * (1 + 1e-12)

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        most = float(np.abs(anchor.astype(np.float64)).max(initial=0)) * self.largest * max(len(anchor), 1)
        if most < 2**53:  # sums of whole numbers that doubles hold exactly
            held = self.floats if rows is None else self.floats[rows]
            return held @ anchor.astype(np.float64)
        held = self.whole if rows is None else self.whole[rows]
        if most < 2**63:
            return held @ anchor
        found = held.astype(object) @ anchor.astype(object)
        if any(abs(score) >= 2**63 for score in found):
            raise OverflowError("an inner product does not fit a long")
        return found.astype(np.int64)


def spanning_tree(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree: anchors from the root on, each after its parent.

    The root is the anchor nearest to the mean and has the parent -1. A parent's children come by
    the size of their subtree, so that intervals of few anchors wait at a time.
    """
    floats = anchors.astype(np.float64)
    n = len(floats)
    root = int(((floats - floats.mean(axis=0)) ** 2).sum(axis=1).argmin())
    parent, edge = np.full(n, -1), np.zeros(n)
    nearest, reached = np.full(n, root), np.zeros(n, bool)
    gap = np.sqrt(((floats - floats[root]) ** 2).sum(axis=1))
    reached[root] = True
    joined = [root]
    for _ in range(n - 1):
        new = int(np.where(reached, np.inf, gap).argmin())
        parent[new], edge[new], reached[new] = nearest[new], gap[new], True
        joined.append(new)
        far = np.sqrt(((floats - floats[new]) ** 2).sum(axis=1))
        closer = ~reached & (far < gap)
        gap[closer], nearest[closer] = far[closer], new
    weight = np.ones(n)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in reversed(joined[1:]):
        weight[parent[node]] += weight[node]
        children[parent[node]].append(node)
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += sorted(children[node], key=lambda child: -weight[child])
    return np.array(order), parent, edge


def _intervals(tree: pa.Table, scorer: Scorer) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row of the tree, lower and upper bounds of all scores there; who takes them may make them narrower.

    Bounds wait only for children that are still to come.
    """
    order, nodes = np.argsort(tree.column("place").to_numpy()), tree.column("node").to_numpy()
    parents, edges = tree.column("parent").to_numpy(), tree.column("edge").to_numpy()
    vectors = vectors_of(tree.column("codes").combine_chunks())
    left = np.bincount(parents[parents >= 0], minlength=int(nodes.max()) + 1)
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for row in order.tolist():
        parent = int(parents[row])
        if parent < 0:
            low = scorer.scores(vectors[row]).astype(np.float64)
            high = low.copy()
        else:
            reach = edges[row] * (1 + 1e-9) * scorer.norms
            low, high = kept[parent][0] - reach, kept[parent][1] + reach
            # Bounds of numbers beyond 2^53 are rounded themselves.
            low -= np.abs(low) * 1e-12
            high += np.abs(high) * 1e-12
            left[parent] -= 1
            if not left[parent]:
                del kept[parent]
        yield row, low, high
        if left[nodes[row]]:
            kept[int(nodes[row])] = (low, high)


def _rescore(scorer: Scorer, anchor: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Exact scores of the rows, which their intervals shrink to."""
    scores = scorer.scores(anchor, rows)
    low[rows] = high[rows] = scores
    return scores.astype(np.int64)


def _floor_of_best(low: np.ndarray, count: int) -> float:
    """A score that `count` of the rows reach for certain, or none."""
    return -np.inf if len(low) < count else float(np.partition(low, len(low) - count)[len(low) - count])


def _best(scores: np.ndarray, ids: np.ndarray, marks: np.ndarray, count: int) -> np.ndarray:
    """Places of the first `count`: higher scores first, then smaller ids, then by contents."""
    return np.lexsort((marks[:, 1], marks[:, 0], ids, -scores))[:count]


class Block:
    """The rows of a block as arrays."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("vec_id").to_numpy()
        self.marks = np.column_stack([table.column(h).to_numpy() for h in ("h1", "h2")])
        self.labels = np.array(table.column("label").to_pylist(), dtype=object)
        self.scorer = Scorer(vectors_of(table.column("codes").combine_chunks()))


def _anchors(tree: pa.Table) -> list[tuple]:
    return list(zip(*(tree.column(name).to_pylist() for name in (*_KEY, "label")), strict=True))


def positives_of(tree: pa.Table, rows: pa.Table, count: int) -> dict[str, list]:
    """The best rows of a block that have each anchor's label."""
    block = Block(rows)
    vectors, told = vectors_of(tree.column("codes").combine_chunks()), _anchors(tree)
    out: dict[str, list] = {name: [] for name in (*_KEY, "positive_id", "p1", "p2", "score")}
    same_label = {label: block.labels == label for label in {t[3] for t in told}}
    for row, low, high in _intervals(tree, block.scorer):
        key, label = told[row][:3], told[row][3]
        others = same_label[label] & ~(
            (block.ids == key[0]) & (block.marks[:, 0] == key[1]) & (block.marks[:, 1] == key[2])
        )
        least = _floor_of_best(low[others], count)
        wanted = np.flatnonzero(others & (high >= least))
        scores = _rescore(block.scorer, vectors[row], wanted, low, high)
        for i in _best(scores, block.ids[wanted], block.marks[wanted], count):
            at = wanted[i]
            values = (*key, block.ids[at], *block.marks[at], scores[i])
            for name, value in zip(out, values, strict=True):
                out[name].append(int(value))
    return out


def negatives_of(tree: pa.Table, rows: pa.Table, count: int, lowest: int, highest: int) -> dict[str, list]:
    """The best rows of a block with other labels in the window of each anchor's positives."""
    block = Block(rows)
    vectors, told = vectors_of(tree.column("codes").combine_chunks()), _anchors(tree)
    windows = tree.column("windows").to_pylist()
    out: dict[str, list] = {name: [] for name in (*_KEY, "positive", "negative_id", "n1", "n2", "score")}
    other_label = {label: block.labels != label for label in {t[3] for t in told}}
    for row, low, high in _intervals(tree, block.scorer):
        key, others = told[row][:3], other_label[told[row][3]]
        given = windows[row] or []
        wanted = np.zeros(len(block.ids), bool)
        for score in set(given):
            bottom, top = lowest * score / 100, highest * score / 100
            slack = abs(score) * 1e-12
            overlaps = others & (high >= bottom - slack) & (low <= top + slack)
            certain = low[others & (low >= bottom + slack) & (high <= top - slack)]
            wanted |= overlaps & (high >= _floor_of_best(certain, count))
        wanted = np.flatnonzero(wanted)
        if not len(wanted):
            continue
        scores = _rescore(block.scorer, vectors[row], wanted, low, high)
        exact = scores.astype(object) if len(scores) and np.abs(scores.astype(float)).max() > 2**55 else scores
        for place, score in enumerate(given):
            inside = (lowest * score <= 100 * exact) & (100 * exact <= highest * score)
            fits = np.flatnonzero(inside.astype(bool))
            for i in fits[_best(scores[fits], block.ids[wanted[fits]], block.marks[wanted[fits]], count)]:
                at = wanted[i]
                values = (*key, place, block.ids[at], *block.marks[at], scores[i])
                for name, value in zip(out, values, strict=True):
                    out[name].append(int(value))
    return out


def rows_taking_part(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, codes and two marks of their contents, each different row once."""
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = given.where(F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False)))
    refused = F.raise_error(F.lit("a component does not fit a long")).cast("long")

    def whole(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x
        return F.when(F.abs(scaled) < float(2**63), F.floor(scaled).cast("long")).otherwise(refused)

    codes = F.transform("embedding", whole)
    given = given.select("vec_id", "label", codes.alias("codes"))
    marks = [F.xxhash64(F.lit(seed), "vec_id", "label", "codes").alias(f"h{seed}") for seed in (1, 2)]
    return given.select("*", *marks).groupBy("vec_id", "h1", "h2").agg(F.first("label").alias("label"), F.first("codes").alias("codes"))


def _locality(codes: Column, length: int) -> Column:
    """Signs against some fixed hyperplanes as one number: vectors near each other often share it."""
    normals = np.random.default_rng([SEED, length]).integers(-8, 9, (12, length))
    total = F.lit(0)
    for k, normal in enumerate(normals.tolist()):
        weights = F.array(*[F.lit(float(w)) for w in normal])
        dot = F.aggregate(F.zip_with(codes, weights, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda s, x: s + x)
        total = total + F.when(dot >= 0, F.lit(1 << (len(normals) - 1 - k))).otherwise(0)
    return total


def hard_negatives(
    vectors: DataFrame,
    scratch: Scratch,
    anchor: Column,
    *,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    tree_anchors: int = TREE_ANCHORS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    `vectors` has vec_id, label and embedding; `anchor` is a condition on vec_id. Rows that share an
    id have their contents' marks beside it (a1, a2, p1, p2, n1, n2).
    """
    spark = vectors.sparkSession
    reachable(spark)
    rows = scratch.write(rows_taking_part(vectors, scale), "rows")
    # One row for each length of vectors: usually one, and bounded by the lengths there are.
    lengths = rows.groupBy(F.size("codes").alias("length")).agg(F.count("*").alias("n"), F.count_if(anchor).alias("anchors"))
    found = [
        _of_one_length(rows, scratch, anchor, row, positives, negatives, lowest, highest, tree_anchors, block_rows)
        for row in lengths.orderBy("length").collect()
        if row["anchors"]
    ]
    if not found:
        return spark.createDataFrame([], _RESULT)
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, "
    "a1 long, a2 long, p1 long, p2 long, n1 long, n2 long"
)


def _of_one_length(rows, scratch, anchor, held, positives, negatives, lowest, highest, tree_anchors, block_rows) -> DataFrame:
    length = held["length"]
    rows = rows.where(F.size("codes") == length)
    block_rows = min(block_rows, max(LEAST_ROWS, min(held["n"] // LEAST_BLOCKS, BLOCK_BYTES // (8 * max(length, 1)))))
    tree_anchors = min(tree_anchors, max(LEAST_ANCHORS, held["anchors"] // LEAST_TREES))
    blocks, trees = -(-held["n"] // block_rows), -(-held["anchors"] // tree_anchors)

    # Trees: anchors by range of the locality code; the id splits a code that many share.
    chosen = rows.where(anchor).select(F.col("vec_id").alias("anchor_id"), F.col("h1").alias("a1"), F.col("h2").alias("a2"), "label", "codes")
    chosen = chosen.withColumn("locality", _locality(F.col("codes"), length))
    ranged = chosen.repartitionByRange(trees, "locality", "anchor_id", "a1", "a2").withColumn("tree", F.spark_partition_id())
    ranged = scratch.write(ranged.drop("locality"), f"anchors-{length}")

    def grown(group: pa.Table) -> pa.Table:
        order, parent, edge = spanning_tree(vectors_of(group.column("codes").combine_chunks()))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes = pa.array(np.arange(len(order)), pa.int64())
        added = {"node": nodes, "place": pa.array(place), "parent": pa.array(parent, pa.int64()), "edge": pa.array(edge)}
        for name, column in added.items():
            group = group.append_column(name, column)
        return group

    shape = f"{_KEYS}, label string, codes array<long>, tree int, node long, place long, parent long, edge double"
    grown_trees = scratch.write(ranged.groupBy("tree").applyInArrow(grown, shape), f"trees-{length}")

    # Every tree meets every block of rows: the stated queries against all rows, in blocks.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "h1", "h2"), F.lit(blocks)).cast("int"))
    dealt = dealt.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def met(asked: DataFrame, work, shape: str) -> DataFrame:
        kinds = [pa.int64()] * len(shape.split(","))

        def both(tree: pa.Table, block: pa.Table) -> pa.Table:
            names = [field.split()[0] for field in shape.split(", ")]
            out = work(tree, block) if tree.num_rows and block.num_rows else {name: [] for name in names}
            return pa.table([pa.array(out[name], kind) for name, kind in zip(names, kinds, strict=True)], names)

        asked = asked.withColumn("block", everywhere)
        return asked.groupBy("tree", "block").cogroup(dealt.groupBy("tree", "block")).applyInArrow(both, shape)

    best = met(grown_trees, lambda t, b: positives_of(t, b, positives), f"{_KEYS}, positive_id long, p1 long, p2 long, score long")
    by_score = Window.partitionBy(*_KEY).orderBy(F.desc("score"), "positive_id", "p1", "p2")
    best = best.withColumn("place", F.row_number().over(by_score) - 1).where(F.col("place") < positives)
    best = scratch.write(best, f"positives-{length}")
    windows = best.groupBy(*_KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("windows"))
    asked = grown_trees.join(windows, _KEY, "left")
    shape = f"{_KEYS}, positive long, negative_id long, n1 long, n2 long, score long"
    near = met(asked, lambda t, b: negatives_of(t, b, negatives, lowest, highest), shape)
    by_score = Window.partitionBy(*_KEY, "positive").orderBy(F.desc("score"), "negative_id", "n1", "n2")
    near = near.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    near = near.withColumnRenamed("score", "negative_score")
    told = best.select(*_KEY, F.col("place").cast("long").alias("positive"), "positive_id", "p1", "p2", F.col("score").alias("positive_score"))
    return near.join(told, [*_KEY, "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "a1", "a2", "p1", "p2", "n1", "n2"
    )
