"""Whitening against exact fractions and a plain decomposition."""

from __future__ import annotations

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from riskloom.llm import whitening


def brute(vectors):
    """vec_id to deviation and whitened, and the shares, from rows (id, vector)."""
    good = [(i, [floor(256 * float(c)) for c in v]) for i, v in vectors if v and all(c is not None and isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, size = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(size)]
    cov = [[float(sum(Fraction(n * x[a] - sums[a], n) * Fraction(n * x[b] - sums[b], n) for x in fit) / n) for b in range(size)] for a in range(size)]
    values, vecs = np.linalg.eigh(np.array(cov))
    values, vecs = values[::-1], vecs[:, ::-1]
    out = []
    for i, x in good:
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        white = centred @ vecs[:, :4] / np.sqrt(values[:4])
        out.append((i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), white))
    return n, out, values[:4] / np.trace(cov)


def check(found, n, wanted, shares):
    rows = {}
    for r in found.collect():
        rows.setdefault((r["vec_id"], int(r["deviation"])), []).append(r)
        assert r["n"] == n and r["identity_error"] < 1e-9
    assert sum(map(len, rows.values())) == 4 * len(wanted)
    signs = np.zeros(4)
    for i, deviation, white in wanted:
        own = sorted(rows[i, deviation], key=lambda r: r["component"])
        got = np.array([r["whitened"] for r in own])[::len(own) // 4]
        if not signs.all():
            signs = np.where(np.abs(white) > 1e-3, np.sign(got * white), signs)
        np.testing.assert_allclose(got * signs, white * (signs != 0), atol=1e-9)
        np.testing.assert_allclose([r["explained"] for r in own][::len(own) // 4], shares, rtol=1e-9)


def test_query_is_the_plain_decomposition(table, result, spark):
    given = [(r["vec_id"], r["embedding"]) for r in table("embeddings").collect()]
    wanted = brute(given)
    check(spark.createDataFrame(result("op12_whitening")), *wanted)


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(c) for c in rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5]]) for i in range(60)]
    hot = rows[0][1]
    rows += [(100 + i, hot) for i in range(40)] + [(None, rows[1][1]), (7, rows[7][1])]
    bad = [(200, None), (201, []), (202, [1.0] * 5), (203, [None] + [1.0] * 5), (204, [float("nan")] * 6), (205, [float("inf")] * 6)]
    schema = "vec_id long, embedding array<double>, x int, component string, n string, whitened int"
    df = spark.createDataFrame([(*r, 1, "a", "b", 2) for r in rows + bad], schema).repartition(5)
    good = {(i, tuple(v)) for i, v in rows}
    n, wanted, shares = brute(sorted(good, key=repr))
    found = whitening.whiten(df)
    assert found.count() == 4 * len(rows) and n == 60
    check(found.dropDuplicates(["vec_id", "component"]), n, wanted, shares)
    assert whitening.whiten(df.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1e9, 1e30])
def test_huge_values_are_exact_or_at_the_ends_of_a_long(spark, size):
    rows = [(0, [size, 0.0]), (1, [-size, 1.0]), (2, [0.25, 2.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[max(-(1 << 63), min((1 << 63) - 1, floor(256 * c))) for c in v] for _, v in rows]
    sums = [sum(v[d] for v in x) for d in range(2)]
    for r in found:
        exact = sum((3 * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
        assert (int(r["deviation"]) if r["deviation"] is not None else None) == (exact if exact < 10**38 else None)


def test_vectors_without_variance(spark):
    found = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert {(r["vec_id"], r["component"], r["n"], int(r["deviation"])) for r in found} == {(i, k, 1, 0) for i in (1, 2) for k in (1, 2)}
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in found)


def test_square_sums_are_exact_whatever_the_size():
    rng = np.random.default_rng(2)
    for bits in (5, 30, 45, 62):
        x = rng.integers(-(1 << bits), 1 << bits, (300, 5))
        centre = np.array([int(c) for c in x.mean(axis=0)], object)
        sums = whitening.square_sums(x, centre)
        rows = [[int(c) - int(m) for c, m in zip(r, centre)] for r in x]
        for i in range(5):
            for j in range(i, 5):
                assert sums[i, j] == sum((r[i] + r[j] if i < j else r[i]) ** 2 for r in rows)
