"""Gates, statistics, registry, ingestion and streaming."""

import datetime as dt
import hashlib
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import gates, stats
from millrace.operators.registry import Registry, RegistryError
from millrace.sources import ingest
from millrace.sources.files import FileStore, checksums
from millrace.streaming import curate as streams


def failed(rules):
    return [rule for _, rule, _, ok in rules if not ok]


def test_landing_gate(spark, tmp_path):
    for name, files in {"ok": {"a.parquet": b"x", "_SUCCESS": b""}, "zero": {"a.parquet": b""}, "marks": {"_SUCCESS": b"", ".x": b"y"}, "none": {}}.items():
        (tmp_path / name).mkdir()
        for f, data in files.items():
            (tmp_path / name / f).write_bytes(data)
    rules = lambda *names: gates.landing_rules(spark, {n: f"file://{tmp_path}/{n}" for n in names})
    assert failed(rules("ok")) == [] and failed(gates.landing_rules(spark, {"a": None})) == []
    assert failed(rules("zero")) == ["zero: no zero-byte file"]
    assert failed(rules("marks")) == ["marks: has data, not only metadata markers"]
    assert failed(rules("none")) == ["none: has objects"]
    with pytest.raises(gates.GateFailure, match="zero-byte"):
        gates.enforce(rules("zero"))


def test_silver_gate(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/{name}")
        return gates.silver_rules(spark, f"file://{tmp_path}/{name}")

    assert failed(write("a", [("1", "x")], "doc_id string, text string")) == []
    assert failed(write("b", [("1", "x")], "id string, text string")) == []
    assert failed(write("c", [(None, "x"), ("1", None)], "doc_id string, text string")) == ["no null ids", "no null texts"]
    assert failed(write("d", [], "doc_id string, text string")) == ["every file has rows", "has rows"]
    assert failed(gates.silver_rules(spark, f"file://{tmp_path}/missing")) == ["has files"]
    with pytest.raises(gates.GateFailure):
        write("e", [("1",)], "doc_id string")


def test_leakage_gate(spark):
    clean = spark.createDataFrame([("1", "some other text")], "doc_id string, text string")
    leak = spark.createDataFrame([("2", f"see: {gates.CANARIES['gsm8k_math_001']}")], "audit_uuid string, raw_audit_narrative string")
    assert failed(gates.leakage_rules(clean)) == []
    rules = gates.leakage_rules(leak)
    assert failed(rules) == ["no benchmark n-gram"] and "'2'" in rules[0][2]
    with pytest.raises(gates.GateFailure):
        gates.leakage_rules(spark.range(1))
    assert gates.should_fire(["success", "skipped"]) and not gates.should_fire(["skipped"]) and not gates.should_fire(["success", "failed"])


def test_wilson_and_tournament(spark):
    rows = [("candidate",)] * 60 + [("baseline",)] * 30 + [("tie",)] * 6 + [("inconsistent",)] * 4
    card = stats.scorecard(spark.createDataFrame(rows, "resolved_winner string")).first()
    assert card["effective_win_rate"] == pytest.approx(0.65) and 0.5 < card["wilson_low"] < 0.65 < card["wilson_high"] < 1 and card["certified"]
    rows = [("candidate",)] * 40 + [("baseline",)] * 55 + [("tie",)] * 5
    assert not stats.scorecard(spark.createDataFrame(rows, "resolved_winner string")).first()["certified"]


def test_pairs(spark):
    c1, c2, t = "Candidate 1", "Candidate 2", "Tie"
    cases = {(c1, c2): "candidate", (c2, c1): "baseline", (t, t): "tie", (c1, c1): "inconsistent", (c2, c2): "inconsistent", (c1, t): "tie", (t, c2): "tie"}
    df = spark.createDataFrame([(*k, v) for k, v in cases.items()], "a string, b string, want string")
    assert df.where(stats.resolve_pair(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_mcnemar():
    assert stats.mcnemar(0, 0) == (0.0, 1.0) and stats.mcnemar(0, 2) == (0.0, 0.5) and stats.mcnemar(3, 3) == (0.0, 1.0)
    chi2, p = stats.mcnemar(30, 10)
    assert chi2 == pytest.approx(361 / 40) and p == pytest.approx(math.erfc(math.sqrt(chi2 / 2)))


def test_bootstrap(spark):
    base, cand = np.array([0, 0, 1, 1, 0.0]), np.array([1, 0, 1, 1, 1.0])
    mean, low, high = stats.bootstrap(base, cand, resamples=500)
    idx = np.random.default_rng(1337).integers(0, 5, size=(500, 5))
    means = (cand - base)[idx].mean(axis=1)
    assert (mean, low, high) == (pytest.approx(0.4), pytest.approx(np.percentile(means, 2.5)), pytest.approx(np.percentile(means, 97.5)))
    rows = [("b", i, float(x), float(y)) for i, (x, y) in enumerate(zip(base, cand, strict=True))]
    df = spark.createDataFrame(rows, "bench string, item int, base double, cand double")
    assert stats.bootstrap_by_key(df, "bench", resamples=500).first()["low"] == pytest.approx(low)
    wide = stats.poisson_bootstrap(df.join(spark.range(60).withColumnRenamed("id", "k")).withColumn("item", F.col("item") * 60 + F.col("k")), "bench").first()
    assert wide["low"] < 0.4 < wide["high"]


GOOD = {"ast_syntax_rate": 1.0, "eos_rate": 0.995, "kv_delta": 1e-4, "pii_leaks": 0, "ece": 0.02, "itl_ms": 10.0, "itl_sla_ms": 25.0, "vram_gb": 12.0, "vram_limit_gb": 24.0}


def release(metrics=None, bench=None, judge=(60, 30, 10, 100)):
    same = np.array([1, 0] * 30)
    return stats.verdict(stats.release_rules(GOOD | (metrics or {}), bench or {"m": (same, same)}, judge, resamples=200))


def test_release():
    assert release()["verdict"] == "PROMOTED"
    for metrics, tier in (({"ast_syntax_rate": 0.99}, 1), ({"eos_rate": 0.98}, 1), ({"kv_delta": 1e-3}, 1), ({"pii_leaks": 1}, 1), ({"ece": 0.07}, 4), ({"itl_ms": 26.0}, 4), ({"vram_gb": 25.0}, 4)):
        out = release(metrics)
        assert out["verdict"] == "QUARANTINED" and not out[f"tier{tier}_passed"] and len(out["rejection_reasons"]) == 1
    assert not release(bench={"m": (np.ones(60), np.zeros(60))})["tier2_passed"]
    assert not release(judge=(0, 0, 0, 100))["tier3_passed"]


def test_calibration_schedule_retention(spark):
    df = spark.createDataFrame([(0.95, True), (0.95, False), (0.15, False), (1.0, True)], "confidence double, correct boolean")
    assert stats.calibration_error(df).first()["ece"] == pytest.approx(3 / 4 * abs(2.9 / 3 - 2 / 3) + 1 / 4 * 0.15)
    lr = [r[0] for r in spark.range(12).select(stats.learning_rate(F.col("id"), warmup=2, total=10, top=1.0, least=0.1)).collect()]
    assert lr[:3] == [0.0, 0.5, 1.0] and lr[10] == pytest.approx(0.1) and lr[11] == 0.1
    snaps = spark.createDataFrame([(i, i != 5) for i in range(7)], "step int, completed boolean")
    assert sorted(r["step"] for r in stats.newest(snaps, 3).collect()) == [3, 4, 6]
    a = stats.fingerprint(snaps).first()
    assert a == stats.fingerprint(snaps.orderBy(F.desc("step")).repartition(3)).first() != stats.fingerprint(snaps.limit(3)).first()


def test_registry(spark, tmp_path):
    reg = Registry(FileStore(spark, f"file://{tmp_path}"), "m")
    ok = {"verdict": "PROMOTED", "sha256": "aa"}
    with pytest.raises(RegistryError, match="verdict"):
        reg.register("1", {"verdict": "QUARANTINED"}, "aa")
    with pytest.raises(RegistryError, match="checksum"):
        reg.register("1", ok, "bb")
    reg.register("1", ok, "aa")
    reg.promote("1")
    with pytest.raises(RegistryError, match="archived"):
        reg.rollback()
    reg.register("2", {"verdict": "PROMOTED"}, "cc")
    assert reg.state()["aliases"] == {"champion": "1", "staged": "2"}
    reg.promote("2")
    assert reg.state()["aliases"] == {"champion": "2", "archived": "1"}
    assert reg.rollback() == "1" and reg.state()["aliases"] == {"champion": "1", "quarantined": "2"}
    with pytest.raises(RegistryError, match="registered"):
        reg.promote("9")


def test_watermarks():
    assert [ingest.watermark(x) for x in (None, "None", "", "null")] == [None] * 4
    assert ingest.watermark("2024-01-01T02:00:00+02:00") == dt.datetime(2024, 1, 1)
    assert (ingest.partitions_for(1, 5000), ingest.partitions_for(1, 100), ingest.partitions_for(5001, 6500)) == (8, 1, 2)
    assert ingest.write_mode(None) == "overwrite" and ingest.write_mode(dt.datetime(2024, 1, 1)) == "append"
    with pytest.raises(ingest.IngestError):
        ingest.guard(0, None)
    assert not ingest.guard(0, dt.datetime(2024, 1, 1)) and ingest.guard(1, None)


LEDGER = "id long, created_at timestamp_ntz, corporate_division string"


def test_incremental_ingest(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d)
    store = ingest.WatermarkStore(FileStore(spark, f"file://{tmp_path}/state"))
    out = f"file://{tmp_path}/bronze"
    first = spark.createDataFrame([(1, at(1), "A"), (2, at(2), "Human Resources"), (3, at(3), None), (4, at(3), "B")], LEDGER)
    assert ingest.ingest(first, out, store, "s") == 2 and store.get("s") == at(3)
    second = first.union(spark.createDataFrame([(5, at(3), "late"), (6, at(4), "A")], LEDGER))
    assert ingest.ingest(second, out, store, "s") == 1 and store.get("s") == at(4)
    assert ingest.ingest(second, out, store, "s") == 0 and store.get("s") == at(4)
    rows = spark.read.parquet(f"{out}/data")
    assert sorted(r["id"] for r in rows.collect()) == [1, 4, 6] and {"year", "month", "day"} <= set(rows.columns)
    third, put = second.union(spark.createDataFrame([(7, at(9), "A")], LEDGER)), store.put
    store.put = lambda *_: (_ for _ in ()).throw(RuntimeError("the driver dies here"))
    with pytest.raises(RuntimeError):
        ingest.ingest(third, out, store, "s")
    store.put = put
    assert ingest.ingest(third, out, store, "s") == 1  # again, from the same watermark: nothing counts twice
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/data").collect()) == [1, 4, 6, 7]
    with pytest.raises(ingest.IngestError):
        ingest.ingest(first.limit(0), f"{out}2", store, "t")
    assert ingest.bounds(first, "id") == (1, 4) and ingest.bounds(first.limit(0), "id") is None
    assert ingest.has_delta(second, at(3), "created_at") and not ingest.has_delta(first, at(3), "created_at")


def test_files(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/sub/a.txt").write_bytes(b"one\n\n--- DOCUMENT BOUNDARY ---\n\ntwo\nlines\n\n--- DOCUMENT BOUNDARY ---\n\nthree\n\n--- DOCUMENT BOUNDARY ---\n\n")
    (tmp_path / "in/b.bin").write_bytes(b"")
    target = FileStore(spark, f"file://{tmp_path}/out")
    assert ingest.land(spark, f"file://{tmp_path}/in", target) == 2
    assert [e.path for e in target.list() if not e.path.endswith(".crc")] == ["b.bin", "sub/a.txt"]
    assert target.read("sub/a.txt") == (tmp_path / "in/sub/a.txt").read_bytes()
    assert ingest.land(spark, f"file://{tmp_path}/in", target, dt.datetime(2999, 1, 1)) == 0
    assert ingest.has_file_delta(spark, f"file://{tmp_path}/in") and not ingest.has_file_delta(spark, f"file://{tmp_path}/in", dt.datetime(2999, 1, 1))
    docs = ingest.boundary_documents(spark, f"file://{tmp_path}/in/sub").orderBy("seq").collect()
    assert [r["text"] for r in docs] == ["one", "two\nlines", "three"]
    assert ingest.landed_files(spark, f"file://{tmp_path}/in").count() == 1
    sums = {Path(r["path"]).name: r["sha256"] for r in checksums(spark, f"file://{tmp_path}/in").collect()}
    assert sums["a.txt"] == hashlib.sha256((tmp_path / "in/sub/a.txt").read_bytes()).hexdigest()


def test_streams_equal_tables(spark, tmp_path):
    streams.configure(spark)
    source = f"file://{tmp_path}/in"
    batch = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(source)
    run = lambda: streams.drain(streams.exact_dedup(streams.clean(streams.read_documents(spark, source))), f"file://{tmp_path}/out", f"file://{tmp_path}/ck")
    batch([(1, "a"), (2, "b"), (3, "<b>a</b>")])
    run()
    batch([(4, "b"), (5, "c")])
    run()
    assert sorted(r["text"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b", "c"]


def test_packing_carries_over(spark, tmp_path):
    source = f"file://{tmp_path}/in"
    batch = lambda rows: spark.createDataFrame(rows, "doc_id long, input_ids array<int>").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: streams.pack(spark.readStream.schema("doc_id long, input_ids array<int>").parquet(source), 10, lanes=1)
    run = lambda: streams.drain(stream(), f"file://{tmp_path}/out", f"file://{tmp_path}/ck")
    batch([(1, list(range(7))), (2, list(range(7, 15)))])
    run()
    batch([(3, list(range(15, 21)))])
    run()
    rows = spark.read.parquet(f"file://{tmp_path}/out").orderBy("seq").collect()
    assert [r["input_ids"] for r in rows] == [list(range(10)), list(range(10, 20))]


def test_jdbc_in_ranges(spark):
    """Against the embedded database that Spark ships for its catalogue."""
    url, props = "jdbc:derby:memory:ledger;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "A" if i % 4 else "Human Resources") for i in range(1, 2001)]
    spark.createDataFrame(rows, "id long, created_at timestamp, corporate_division string").write.option("createTableColumnTypes", "corporate_division VARCHAR(30)").jdbc(url, "ledger", properties=props)
    read = lambda since=None: ingest.read_jdbc(spark, url, "ledger", since=since, properties=props)
    full = read()
    assert full.rdd.getNumPartitions() == 3 and full.count() == 1500
    assert sorted(r["id"] for r in read(dt.datetime(2024, 1, 2, 9, 18)).collect()) == [1999]
    assert read(dt.datetime(2030, 1, 1)) is None
