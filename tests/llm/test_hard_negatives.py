"""Hard negatives: bounds, trees, and results against all scores."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roundhaul.llm import hard_negatives
from roundhaul.llm.common import Scratch

ROWS = "vec_id long, embedding array<double>, label int, rank string, score int, tree int, block int, a1 string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], ROWS)


def brute(rows, positives=5, negatives=10, scale=256, lowest=30, highest=90):
    held = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, label) or vector is None or not all(x is not None and np.isfinite(x) for x in vector):
            continue
        held[vec_id, label, tuple(int(np.floor(scale * x)) for x in vector)] = True
    out = []
    for anchor in held:
        if anchor[0] % 100:
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], o[2], strict=True)), o) for o in held if o != anchor and len(o[2]) == len(anchor[2])]
        scored.sort(key=lambda s: (-s[0], s[1][0]))
        for score, positive in [s for s in scored if s[1][1] == anchor[1]][:positives]:
            inside = [s for s in scored if s[1][1] != anchor[1] and lowest * score <= 100 * s[0] <= highest * score]
            out += [(anchor[0], positive[0], k + 1, n[0], score, s) for k, (s, n) in enumerate(inside[:negatives])]
    return sorted(out)


def found(spark, rows, **settings):
    frame = hard_negatives.hard_negatives(vectors(spark, rows), Scratch(spark, "test"), F.col("vec_id") % 100 == 0, **settings)
    names = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    return sorted(tuple(r[n] for n in names) for r in frame.collect())


def test_odd_rows(spark):
    nan, e = float("nan"), [1.0, 0.5, -0.25]
    rows = [
        (0, e, 1), (1, e, 1), (1, e, 1), (2, [0.9, 0.5, 0.0], 1), (3, [0.8, 0.4, 0.0], 2), (4, [0.7, 0.4, 0.0], 2), (5, [0.7, 0.4, 0.0], 3),
        (6, None, 1), (7, e, None), (8, [nan, 1.0, 1.0], 2), (9, [None, 1.0, 1.0], 2), (None, e, 1), (100, e, 1), (200, [], 1),
        (10, [], 2), (11, [], 1), (12, [1.0, 1.0], 2), (300, [1.0, 1.0], 1), (400, [0.0, 0.0, 0.0], 5), (13, [0.0, 0.0, 0.0], 5),
        (14, [float("inf"), 0.0, 0.0], 2), (-100, [0.2, 0.2, 0.2], 2),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, [(1, e, 1)]) == [] and found(spark, [(0, e, 1)]) == []


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_against_all_scores(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.standard_normal((4, 6))
    rows = []
    for i in range(900):
        vector = centres[i % 4] + spread * rng.standard_normal(6)
        rows.append((i * 10, [float(x) for x in vector], int(rng.integers(0, 3))))
    rows += [(100_003 + i, rows[0][1], 0) for i in range(40)]  # ties
    assert found(spark, rows, block_rows=200, tree_anchors=16) == brute(rows)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i * 50, [float(x) for x in rng.standard_normal(4) * 3e6], i % 3) for i in range(60)]
    assert found(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, [(0, [1e9] * 4, 1), (1, [1e9] * 4, 1), (2, [1e8] * 4, 2)])


def test_same_id_with_other_contents(spark):
    rows = [(0, [1.0, 0.0], 1), (5, [0.9, 0.0], 1), (5, [0.8, 0.1], 2), (6, [0.5, 0.0], 2), (0, [0.5, 0.5], 1)]
    assert found(spark, rows) == brute(rows)


def test_spanning_tree():
    points = np.array([[0, 0], [0, 10], [0, 11], [50, 0], [50, 1], [0, 10]])
    order, parent, edge = hard_negatives.spanning_tree(points)
    assert sorted(order.tolist()) == list(range(6)) and parent[order[0]] == -1
    place = {int(node): k for k, node in enumerate(order)}
    assert all(place[int(parent[i])] < place[i] for i in range(6) if parent[i] >= 0)
    assert edge.sum() == pytest.approx(10 + 0 + 1 + 50 + 1)


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(1)
    anchors = (rng.standard_normal((1, 8)) * 200 + rng.standard_normal((20, 8))).astype(np.int64)
    block = (rng.standard_normal((500, 8)) * 256).astype(np.int64)
    order, parent, edge = hard_negatives.spanning_tree(anchors)
    place = np.argsort(order)
    tree = pa.table(
        {
            "node": np.arange(20), "place": place, "parent": parent, "edge": edge,
            "codes": pa.array(anchors.tolist(), pa.list_(pa.int64())),
        }
    )
    scorer = hard_negatives.Scorer(block)
    for row, low, high in hard_negatives._intervals(tree, scorer):
        exact = block @ anchors[row]
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).max() < 2 * 20 * 20 * scorer.norms.max()
