"""Whitening against arithmetic in whole numbers and fractions, and odd rows."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundhaul.llm import whitening
from roundhaul.llm.common import Scratch
from roundhaul.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, label int, n string, x int, whitened string, deviation string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", 2, "b", "c") for i, v in rows], ROWS)


def brute(rows):
    """n, sums, covariance as fractions, and the whole vectors of what takes part."""
    held = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows]
    n, width = len(held), len(held[0][1])
    sums = [sum(x[k] for _, x in held) for k in range(width)]
    centred = [[n * x[k] - sums[k] for k in range(width)] for _, x in held]
    cov = [[Fraction(sum(y[i] * y[j] for y in centred), n**3) for j in range(width)] for i in range(width)]
    return n, sums, cov, held, centred


def compare(out, rows, components=32):
    n, sums, cov, held, centred = brute(rows)
    matrix = np.array([[float(c) for c in row] for row in cov])
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(sum(cov[i][i] for i in range(len(cov))))
    count = min(components, len(values))
    assert len(out) == len(held) * count
    by = {}
    for row in out:
        by.setdefault(row["vec_id"], {})[row["component"]] = row
    signs = None
    for (vec_id, _), y in zip(held, centred, strict=True):
        mine = [by[vec_id][k + 1] for k in range(count)]
        wanted = (np.array(y, float) / n) @ axes[:, :count] / np.sqrt(values[:count])
        got = np.array([r["whitened"] for r in mine])
        if signs is None or (np.abs(wanted) > 1e-3).all():
            now = np.sign(got * wanted)
            assert signs is None or (now == signs).all()
            signs = now
        assert np.allclose(np.abs(got), np.abs(wanted), atol=1e-7)
        assert {(r["n"], int(r["deviation"])) for r in mine} == {(n, sum(c * c for c in y))}
        assert np.allclose([r["explained"] for r in mine], values[:count] / trace, rtol=1e-9)
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9


def test_query(spark, sf_dir):
    given = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    compare(QUERIES["op13_whitened_vectors"](spark, sf_dir).collect(), given)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(x) for x in np.float32(rng.standard_normal(4) * [1, 5, 2, 9])]) for i in range(50)]
    good += [(100, good[0][1]), (101, [0.0] * 4)]
    bad = [(200, None), (201, [nan, 0.0, 0.0, 0.0]), (202, [None, 0.0, 0.0, 0.0]), (203, [inf, 0.0, 0.0, 0.0]), (204, [])]
    out = whitening.whiten(vectors(spark, good + bad), Scratch(spark, "test")).collect()
    compare(out, good)
    compare(whitening.whiten(vectors(spark, good), Scratch(spark, "test"), 2).collect(), good, 2)
    repeated = whitening.whiten(vectors(spark, [*good, (5, [1.0] * 4), (None, [2.0] * 4), (5, [1.0] * 4)]), Scratch(spark, "test"))
    assert repeated.where("vec_id = 5").count() == 12 and repeated.where("vec_id IS NULL").count() == 4


def test_without_variance(spark):
    assert whitening.whiten(vectors(spark, []), Scratch(spark, "test")).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [0.5, 2.0])]), Scratch(spark, "test")).collect() == []
    flat = [(i, [float(i), 7.0, 2.0 * i]) for i in range(9)]  # one direction only
    out = whitening.whiten(vectors(spark, flat), Scratch(spark, "test")).collect()
    assert {r["component"] for r in out} == {1} and out[0]["explained"] == pytest.approx(1)
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]), Scratch(spark, "test"))


@pytest.mark.parametrize("size", [10, 2**20, 2**40, 2**61])
def test_squares_are_exact(size):
    rng = np.random.default_rng(7)
    values = rng.integers(-size, size, (300, 3))
    assert whitening.square_sums(values) == [sum(int(v) ** 2 for v in column) for column in values.T]
    sums = whitening.polarised_sums(values)
    cross = whitening.cross_sums(sums, 3)
    assert cross == [[sum(int(a) * int(b) for a, b in zip(one, two, strict=True)) for two in values.T] for one in values.T]


def test_large_values(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(3) * 1e9)]) for i in range(40)]
    compare(whitening.whiten(vectors(spark, rows), Scratch(spark, "test")).collect(), rows)
    with pytest.raises(Exception, match="range of a long|overflow|OVERFLOW"):
        whitening.whiten(vectors(spark, [(1, [1e30]), (2, [2e30])]), Scratch(spark, "test")).agg(F.sum("whitened")).collect()
