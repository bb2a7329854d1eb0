from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing

from ..compare import same
from .helpers import WORDS, frame, odd_rows, rng, sentence


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Water-filling as the contract words it: cap, reshare, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, held = sum(sizes.values()), {}, {}
    while True:
        left = total - sum(held.values())
        open_ = [s for s in order if s not in held]
        share = sum(w[s] for s in open_)
        target = {**held, **{s: left * w[s] / share for s in open_}}
        above = [s for s in open_ if target[s] > cap * sizes[s]]
        if not above:
            return target
        held |= {s: float(cap * sizes[s]) for s in above}
        if len(held) == len(order):
            return held


def corpus(seed=3):
    r = rng(seed)
    rows, n = [], 0
    for source, docs, words in (("a", 30, 40), ("b", 4, 10), ("é", 60, 80), (None, 10, 30), ("Z", 1, 500), ("void", 3, 0)):
        for _ in range(docs):
            rows.append((n, sentence(r, r.randrange(words + 1)), "en", source))
            n += 1
    return rows


def test_targets_and_taken(spark):
    rows = corpus() + odd_rows(rng())
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(WORDS.findall(text or ""))
    want = brute_targets(dict(sizes))
    out = mixing.mix_plan(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - want[source]) <= 1


def test_reruns_and_partitions_agree(spark):
    docs = frame(spark, corpus())
    one = sorted(mixing.mix_plan(docs.repartition(7)).collect())
    two = sorted(mixing.mix_plan(docs.coalesce(1)).collect())
    assert one == two


def test_a_plain_division_needs_no_cap(spark):
    rows = [(i, "x " * 100, "en", s) for i, s in enumerate(["a", "b", "c"])]
    out = {r["source"]: r["target"] for r in mixing.mix_plan(frame(spark, rows)).collect()}
    assert out == {"a": 187.5, "b": 75.0, "c": 37.5}


def test_empty_table(spark):
    assert mixing.mix_plan(frame(spark, [])).count() == 0
    assert mixing.mix_plan(frame(spark, [(1, "", "en", "a")])).collect()[0]["taken"] == 0


def test_documents_as_often_as_taken(spark):
    docs = frame(spark, corpus())
    out = mixing.mix_documents(docs)
    assert out.columns == [*docs.columns, "epoch"]
    plan = {r["doc_id"]: r for r in mixing.mix_plan(docs).collect()}
    for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect():
        p = plan[r["doc_id"]]
        assert r["n"] == p["whole"] + (p["part"] * 2 >= p["size"] > 0 and p["part"] > 0)


def clashing(spark, names):
    """The corpus with columns of these names, each with values of its own."""
    docs = frame(spark, corpus()).select("doc_id", "text", "source")
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.col("doc_id") * 100 + k)
    return docs


def test_columns_of_any_name_come_through(spark):
    names = ["size", "target", "part", "rest", "end_range", "end_words", "whole", "taken", "key", "row", "times", "source_size", "weight", "a.b", "range", "level"]
    docs = clashing(spark, names)
    out = mixing.mix_documents(docs)
    assert out.columns == [*docs.columns, "epoch"]
    rows = out.collect()
    assert rows and all(r[name] == r["doc_id"] * 100 + k for r in rows for k, name in enumerate(names))
    plain = mixing.mix_documents(docs.select("doc_id", "text", "source"))
    assert sorted((r["doc_id"], r["epoch"]) for r in rows) == sorted((r["doc_id"], r["epoch"]) for r in plain.collect())


def test_an_epoch_of_ones_own_is_replaced(spark):
    out = mixing.mix_documents(clashing(spark, ["epoch"]))
    assert out.columns == ["doc_id", "text", "source", "epoch"] and out.agg(F.max("epoch")).first()[0] < 4


def test_a_budget_ends_in_one_of_many_ranges(spark, monkeypatch):
    docs = frame(spark, corpus() + odd_rows(rng()))
    one = sorted(map(tuple, mixing.mix_plan(docs).collect()), key=repr)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    assert sorted(map(tuple, mixing.mix_plan(docs).collect()), key=repr) == one


def test_sql(spark, sf_dir, duck):
    same(mixing.mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "source", "whole", "part"), duck, mixing.SQL)


def test_sql_of_capped_sources(spark, tmp_path):
    import duckdb

    frame(spark, corpus() + odd_rows(rng())).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/d/*.parquet')")
    same(mixing.mix_plan(spark.read.parquet(f"{tmp_path}/d")), con, mixing.SQL)
