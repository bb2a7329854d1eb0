import math

import numpy as np
import pytest

from millrace.llm import vafile

from ..compare import same


def brute(rows, k=5, every=50):
    rows = sorted({(i, tuple(v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}, key=repr)
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    out = []
    for q, v in ints:
        if q is None or q % every:
            continue
        scores = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i is None, i) for i, w in ints if i != q and len(w) == len(v)), key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(q, n + 1, s[2], -s[0]) for n, s in enumerate(scores[:k])]
    return sorted(out, key=repr)


def capped(rows):
    """Scores as the nearest long."""
    return sorted(((q, n, i, max(-(2**63), min(2**63 - 1, s))) for q, n, i, s in rows), key=repr)


def run(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(i, v, 1, 0) for i, v in rows], f"vec_id long, embedding array<{kind}>, row int, score int")
    return sorted((tuple(r) for r in vafile.top_k(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 4, 9])
def test_against_a_full_scan(spark, monkeypatch, bits):
    monkeypatch.setattr(vafile, "BLOCK", 40)
    r = np.random.default_rng(bits)
    rows = [(i, [float(x) for x in np.float32(r.normal(0, 0.3, 12))]) for i in range(400)]
    assert run(spark, rows, bits=bits) == brute(rows)


def test_ties_repeats_and_unusable_vectors(spark):
    one = [0.5, -0.25]
    rows = [(i, one) for i in range(0, 120)] + [(50, one), (3, one), (None, one), (130, None), (131, [None, 1.0]), (132, [float("nan"), 1.0]), (133, [float("inf"), 1.0]), (134, [1.0]), (150, [2.0]), (200, [])]
    assert run(spark, rows) == brute(rows)


def test_fewer_than_k_and_nothing(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert run(spark, rows) == [(0, 1, 1, 131072), (0, 2, 2, -65536)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_large_components_stay_exact(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.integers(-(2**20), 2**20, 3)]) for i in range(120)]
    assert run(spark, rows, kind="double") == brute(rows)


@pytest.mark.parametrize("size", [1e8, 1e14, 1e30, 1e149])
def test_components_of_any_finite_size_do_not_overflow(spark, size):
    r = np.random.default_rng(7)
    rows = [(i, [float(x) for x in r.normal(0, 1, 4) * (size if i % 3 else 1.0)]) for i in range(160)]
    got, want = run(spark, rows, kind="double"), capped(brute(rows))
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert all(abs(x[3] - y[3]) <= abs(y[3]) * 1e-12 for x, y in zip(got, want, strict=True))


def test_beyond_what_products_can_hold_takes_no_part(spark):
    assert run(spark, [(0, [1.0]), (1, [1e200]), (2, [2.0])], kind="double") == [(0, 1, 2, 131072)]


def test_long_arithmetic_is_exact(spark):
    rows = [(i, [float(2**22), float(2**21 + i), float(i)]) for i in range(60)]
    assert run(spark, rows, kind="double") == brute(rows)


def test_a_common_vector_is_scored_once(spark):
    rows = [(i, [0.5, 0.5]) for i in range(300)] + [(1000 + i, [0.5, i / 256]) for i in range(130)]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    classes = vafile.vector_classes(vafile.keyed(df, "vec_id", "embedding"), 5).collect()
    assert len(classes) == 130 and max(len(c["ids"]) for c in classes) == 6


def test_queries_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch):
    """Each lane of cells meets all queries; what files hold of them, once and compressed, says nothing of that."""
    monkeypatch.setattr(vafile, "BLOCK", 40)
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.integers(-2, 3, 16) / 4]) for i in range(400)]
    plans, write = {}, vafile.written

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(vafile, "written", kept)
    assert run(spark, rows, every=4) == brute(rows, every=4)
    assert plans["va-bounds"].count("BroadcastExchange") <= 1  # the cells' geometry, a row for each number of components


def test_queries_are_broadcast_by_their_size_in_memory(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "queries")
    spark.range(200).selectExpr("id as query", "id as query_id", "array_repeat(1.0D, 64) as v").write.parquet(path)
    queries, pairs = spark.read.parquet(path), spark.range(1000).selectExpr("id as row", "id % 200 as query")
    classes = spark.range(1000).selectExpr("id as row", "array_repeat(2.0D, 64) as v", "array(id) as ids")
    plan = lambda: vafile.exact_scores(pairs, vafile.beside(queries), classes)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan()
    monkeypatch.setattr(vafile, "BROADCAST_BYTES", 50_000)  # 200 rows of 64 doubles have twice that, their files a tenth
    assert "rightHint=(strategy=merge)" in plan()


def test_bounds_hold():
    r = np.random.default_rng(5)
    v, q = r.integers(-300, 300, (50, 8)), r.integers(-300, 300, (6, 8))
    low, width = v.min(0), (v.max(0) - v.min(0)) // 16 + 1
    lower, upper = vafile.score_bounds(q.astype(float), *vafile.cell_bounds(((v - low) // width).astype(float), low.astype(float), width.astype(float)))
    assert (lower <= q @ v.T).all() and (q @ v.T <= upper).all()


def test_sql(spark, sf_dir, duck):
    same(vafile.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), duck, vafile.SQL)
