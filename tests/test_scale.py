"""What keeps operators' time and memory in proportion: work done once, and nothing kept from text to text."""

import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.functions import arrow, text as tx
from millrace.operators import curate, lsh
from millrace.plans import catalog

from .test_operators import docs, ids


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# F2


def test_equal_texts_of_a_batch_are_parsed_once():
    seen = []
    out = arrow._parsed(pa.array(["a", "b", None, "a"] * 100), lambda s: seen.append(s) or len(s), pa.int32())
    assert out.to_pylist() == [1, 1, 0, 1] * 100 and len(seen) <= 3


def test_nested_functions_take_one_pass():
    text = "".join("    " * k + f"def f{k}(x):\n" for k in range(60)) + "    " * 60 + "return x if x and x > 1 else 0\n"
    assert arrow.complexity(text) == 60 + 60 * 2
    assert arrow.complexity("class A:\n    @d(1 if x else 2)\n    def f(self):\n        return [y for y in x if y if z]\nif a: pass\n") == 1 + 1 + 3


def test_lexer_errors_with_and_without_odd_characters(spark):
    texts = ["x = 1; y[2] // a", "x `` y", "'open", '"shut"', "", "é", "a\\b", "$", "\x0b"]
    want = [0.0, 2 / 6, 1 / 2, 0.0, 0.0, 1.0, 1 / 3, 1.0, 1.0]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(tx.lexer_error_ratio(F.col("t"))).collect()] == pytest.approx(want)


def test_made_up_code_is_dealt_over_tasks(spark, sf_dir):
    assert catalog._code(spark, sf_dir, "x").rdd.getNumPartitions() > 1


# F6


def test_parsed_names_do_not_stay(monkeypatch):
    monkeypatch.setattr(arrow, "OWN", 0)
    texts = pa.array([f"def name_{i}(argument_{i}):\n    return argument_{i}\n" for i in range(20_000)])
    arrow._parsed(texts.slice(0, 10), arrow.complexity, pa.int32())
    before = sys.getallocatedblocks()
    assert set(arrow._parsed(texts, arrow.complexity, pa.int32()).to_pylist()) == {1}
    assert sys.getallocatedblocks() - before < 5_000


# F9


def test_a_batch_is_not_held_as_python_strings():
    batch = pa.array(["ä" * 50_000] * 400)
    tracemalloc.start()
    out = arrow._each(batch, lambda s: s.upper(), pa.string())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 400 and out[399].as_py() == "Ä" * 50_000 and peak < 8 << 20


# F7


def test_gram_share_is_computed_once_and_not_by_lambdas(spark, sf_dir):
    found = plan(catalog.QUERIES["ngram_repetition"](spark, sf_dir))
    assert found.count("ArrowEvalPython") == 1 and "lambda" not in found
    prose = plan(curate.prose_filter(catalog.table(spark, sf_dir, "documents")))
    assert prose.count("ArrowEvalPython") == 1 and "lambda" not in prose


def test_gram_share_splits_at_white_space_of_any_script(spark):
    texts = ["\u3000".join("aAabcdefghijklmnop"), "\x1c".join("abcdefghijklmnopq"), "a b\x1f" * 20, "\u2028a\u00a0b\x85c " * 9, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(tx.top_gram_share(tx.text("t"))).collect()]
    # a separator of ASCII isn't white space to Unicode: the second text is one word, the third has 21 of which 19 are equal
    assert got == pytest.approx([1 / 16, 0.0, 17 / 19, 9 / 25, 0.0])


# F8


def test_minhashes_equal_those_of_one_bag_at_a_time():
    r = random.Random(8)
    bags = [[f"w{r.randrange(3000)}" for _ in range(n)] for n in (0, 1, 5, 900, 1500, 3, 2048, 0, 7)]
    a, b = (lambda g: (g.integers(1, 1 << 29, 128, dtype=np.uint64), g.integers(0, 1 << 60, 128, dtype=np.uint64)))(np.random.default_rng(1))
    plain = [[min((xxhash.xxh32_intdigest(w) * int(x) + int(y)) % ((1 << 61) - 1) for w in bag or [""]) for x, y in zip(a[:4], b[:4])] for bag in bags]
    assert arrow.minhashes(bags, 128)[:, :4].tolist() == plain


def test_only_firsts_of_equal_signatures_take_part_in_rounds(spark, monkeypatch):
    r = random.Random(9)
    texts = ["\n".join(f"line {(k % 12) // r.choice([1, 1, 2])} {j}" for j in range(6)) for k in range(120)]
    df, shingles, seen = docs(spark, texts), lsh.code_shingles(tx.text("text")), []
    keyed = lsh.band_keys(df, shingles, 0.80).select("doc_id", F.posexplode("keys").alias("band", "key"))
    want, plain = ids(lsh.losers(keyed)), lsh.losers
    monkeypatch.setattr(lsh, "losers", lambda bands: seen.append(bands.select("doc_id").distinct().count()) or plain(bands))
    gone, staying = lsh.collided(df, shingles, 0.80)
    assert ids(gone) == want and ids(staying) == sorted(set(range(120)) - set(want)) and seen[0] < 120


# F1, F4


def test_a_composed_text_is_computed_once(spark, sf_dir):
    found = plan(curate.strip_boilerplate(curate.normalise(catalog.table(spark, sf_dir, "documents"))))
    assert found.count(tx.HYPHENATED) <= 4  # what composition takes and gives; it was pasted in at each mention of the text


def test_a_signature_takes_one_digest(spark, sf_dir):
    assert plan(catalog.QUERIES["content_signature"](spark, sf_dir)).count("md5(") == 1
