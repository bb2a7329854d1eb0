"""Fixture generators."""

import re

from millrace.sources import seed


def test_replication(spark):
    text = "AAPL by Trader-12 from 10.0.0.1, ORD-5 and Account #77 at 0xABCDEF"
    seeds = spark.createDataFrame([("k1", 100.0, text), ("k2", 50.0, "import os"), ("k3", 10.0, "select 1 from t")], "audit_uuid string, amount double, narrative string")
    rows = seed.replicate(seeds, 300, order="audit_uuid").collect()
    assert rows == seed.replicate(seeds, 300, order="audit_uuid").collect() and len({r["audit_uuid"] for r in rows}) == len(rows) == 300
    for r in rows:
        base = (100.0, 50.0, 10.0)[r["row"] % 3]
        assert 0.95 * base - 0.01 <= r["amount"] <= 1.05 * base + 0.01
        if r["row"] % 3 == 0:
            m = re.fullmatch(r"\[\w+\] TRACE_ID:[0-9A-F]{8} - (\w+) by Trader-\d{4} from (\d+\.){3}\d+, ORD-\d{6} and Account #\d{6} at 0x[0-9a-f]{6}", r["narrative"])
            assert m and m[1] in seed.TICKERS and "10.0.0.1," not in r["narrative"]
        else:
            assert r["narrative"].startswith(("# [", "/* [")[r["row"] % 3 - 1])
    assert seed.replicate(seeds.limit(0), 5, order="audit_uuid").count() == 0


def test_landing_text(spark):
    docs = spark.createDataFrame([("f", 1, "b"), ("f", 0, "a")], "file string, seq int, text string")
    assert seed.as_landing_text(docs).first()["value"].count("DOCUMENT BOUNDARY") == 2
