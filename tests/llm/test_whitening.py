"""Whitening against numpy on the whole matrix, and its defined results."""

from __future__ import annotations

import numpy as np
import pytest

from demandgrid.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, x string, weight string, k1 string"


def expected(vectors, weights=None):
    """Eigenvalues, trace and the whitened rows of the distinct integer vectors."""
    x = np.array(vectors, dtype=float)
    w = np.ones(len(x)) if weights is None else np.array(weights, dtype=float)
    centred = x - (x * w[:, None]).sum(axis=0) / w.sum()
    covariance = (centred * w[:, None]).T @ centred / w.sum()
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values)
    return values[order], np.trace(covariance), centred @ columns[:, order] / np.sqrt(np.maximum(values[order], 1e-300))


def integers(vector):
    return tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in vector)


def check(rows, vectors, weights=None, components=16):
    """``vectors`` by id; every row against numpy, up to the sign of a component."""
    distinct = sorted(set(vectors.values()))
    counts = None if weights is None else [weights[v] for v in distinct]
    values, trace, white = expected(distinct, counts)
    place = {v: i for i, v in enumerate(distinct)}
    n = len(distinct) if counts is None else sum(counts)
    sums = [sum(v[d] * (1 if counts is None else counts[place[v]]) for v in distinct) for d in range(len(distinct[0]))]
    kept = min(components, len(distinct[0]))
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, k + 1) for i in vectors for k in range(kept))
    signs = {}
    for r in sorted(rows, key=lambda r: -abs(r.whitened)):
        wanted = white[place[vectors[r.vec_id]], r.component - 1]
        sign = signs.setdefault(r.component, np.sign(wanted * r.whitened))
        assert r.whitened == pytest.approx(sign * wanted, abs=1e-8)
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
        assert r.n == n and r.identity_error < 1e-9
        assert r.deviation == sum((n * e - s) ** 2 for e, s in zip(vectors[r.vec_id], sums, strict=True))


def test_query_equals_numpy(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(queries.QUERIES["op11_whitening"](spark, SF_DIR).collect(), {r.vec_id: integers(r.embedding) for r in table})


def awkward(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(e) for e in row] for row in rng.normal(size=(40, 5))]
    rows = [(i, v, "clash", "clash", None) for i, v in enumerate(vectors)]
    rows += [(100 + i, vectors[0], None, None, None) for i in range(30)]
    unusable = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1e300] * 5]
    rows += [(200 + i, v, None, None, None) for i, v in enumerate(unusable)]
    return spark.createDataFrame(rows, SCHEMA), {r[0]: integers(r[1]) for r in rows if r[0] < 200}


def test_repeated_vectors_count_once_and_unusable_rows_go(spark):
    docs, vectors = awkward(spark)
    check(whitening.whiten(docs, components=3).collect(), vectors, components=3)


def test_weights_by_count(spark):
    docs, vectors = awkward(spark)
    counts = {v: list(vectors.values()).count(v) for v in vectors.values()}
    rows = whitening.whiten(docs, by_count=True).collect()
    check(rows, vectors, counts)
    assert {r.weight for r in rows if r.vec_id >= 100} == {31}


def test_no_rows_one_vector_and_several_lengths(spark):
    docs, _ = awkward(spark)
    empty = whitening.whiten(docs.where("vec_id < 0"))
    assert empty.count() == 0 and set(empty.columns) > {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    one = whitening.whiten(docs.where("vec_id = 0 or vec_id >= 100")).collect()
    assert len(one) == 31 * 5 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)] + [(None, [0.0, 0.0])], "vec_id long, embedding array<float>")
    rows = whitening.whiten(flat).collect()
    assert {r.whitened is None for r in rows if r.component == 2} == {True} and all(r.identity_error < 1e-9 for r in rows)
    assert sum(r.vec_id is None for r in rows) == 2
    with pytest.raises(ValueError, match="one length"):
        whitening.whiten(flat.union(spark.createDataFrame([(9, [1.0])], flat.schema)))


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i) * 2**30, float(i * i), 1.0]) for i in range(6)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    vectors = {i: integers(v) for i, v in rows}
    sums = [sum(v[d] for v in vectors.values()) for d in range(3)]
    for r in found:
        exact = sum((6 * e - s) ** 2 for e, s in zip(vectors[r.vec_id], sums, strict=True))
        assert r.deviation == (exact if exact < 1 << 63 else None)
