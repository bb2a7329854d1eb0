"""Curation operators on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import arrow
from millrace.operators import curate, lsh


def docs(spark, texts, **columns):
    rows = [(i, t, *[v[i] for v in columns.values()]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {c} string" for c in columns))


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_exact_dedup_and_history(spark):
    one = curate.exact_dedup(docs(spark, ["a", "b", "b", "c", None, ""]).repartition(5))
    assert ids(one) == [0, 1, 3, 4] and dict(one.dtypes)["document_hash_signature"] == "bigint"
    assert ids(curate.exact_dedup(docs(spark, ["b", "new", "new"]), one)) == [1]


def test_routing(spark):
    df = docs(spark, ["plain words", "plain words", "{};[]=<>", "{};[]=<>"], source_type=["github_repo", "web", "web", None])
    route = lambda **kw: [r["branch_id"] for r in curate.route(df, **kw).orderBy("doc_id").collect()]
    assert route() == [1, 0, 1, 1]
    assert route(is_code=lambda t: F.lit(False)) == [1, 0, 0, 0]
    routed = curate.route(df)
    assert ids(curate.branch(routed, 0)) == [1]
    both = curate.union_branches(curate.branch(routed, 0).withColumn("a", F.lit(1)), curate.branch(routed, 1).withColumn("b", F.lit(2)))
    assert both.count() == 4 and {"a", "b"} <= set(both.columns)


def test_prose(spark):
    good = "The cat sat on the mat, and the dog is in a house of brick that we know."
    assert ids(curate.prose_filter(docs(spark, [good, "no stops here", "a!!!!!", "of the of the # # # # .", None, "the of, a " * 8]))) == [0]


def test_prose_boundaries(spark):
    t = " ".join(["a,"] * 3 + ["a"] * 7)
    assert ids(curate.prose_filter(docs(spark, [t, t.replace(" a a", " a. a", 1)]))) == [0]


def test_code(spark):
    code = "def f(x):\n    return [x] == {1: 2}\n"
    long = "x = [1];" * 260
    assert ids(curate.code_filter(docs(spark, [code, "plain licence prose without any", long, "{};=" * 9]))) == [0]
    assert ids(curate.code_filter(docs(spark, [code, f"a\n```\n{code}NOISE\n```"]), noise=lambda s: F.when(s.contains("NOISE"), 0.85).otherwise(0.1))) == [0]


def test_quality(spark):
    out = curate.quality_filter(docs(spark, ["good", "bad", "odd", " "]), lambda t: F.when(t == "good", "hq").when(t == "bad", "lq").otherwise("other"), lambda t: F.when(t == "good", 0.92).otherwise(0.80))
    assert {(r["doc_id"], r["cqf_quality_score"]) for r in out.collect()} == {(0, 0.92), (3, 1.0)}
    assert curate.quality_filter(docs(spark, ["x"])).first()["cqf_quality_score"] == 1.0


def test_domain_quality(spark):
    branches = lambda n: "def f(x):\n" + "".join(f"    if x > {i}:\n        x += 1\n" for i in range(n)) + "    return x\n"
    assert ids(curate.domain_quality(docs(spark, [branches(0), branches(1), branches(49), branches(50), "x = 1"]))) == [1, 2]


def test_languages(spark):
    en, de = "The cat is in the house and it was good for that.", "Der Hund ist nicht in dem Haus und die Katze mit den Hunden ist von das."
    df = docs(spark, [f"{en}\n\n{en}", f"{en}\n\n{de * 3}", "", None])
    assert ids(curate.language_filter(df, curate.guess_language)) == [0, 2, 3]


def test_syntax(spark):
    df = docs(spark, ["def f():\n    return 1", "def f()\n    return 1", "x = 1 +", "SELECT a FROM t WHERE a > 1", "SELECT a ="])
    assert ids(curate.syntax_filter(df)) == [0, 3]


def test_toxicity_and_redaction(spark):
    df = docs(spark, ["fine a@b.org", "nasty", " "])
    score = lambda t: F.when(t == "nasty", 0.85).otherwise(F.lit(None).cast("double"))
    assert [r["text"] for r in curate.redact(curate.toxicity_filter(df, score)).orderBy("doc_id").collect()] == ["fine [EMAIL_ADDRESS]", " "]
    stamped = curate.redact(df, stamp="safety_audited_at")
    assert stamped.first()["safety_audited_at"].endswith("+00:00")


def brute_chunks(text, most):
    """The chunker, one paragraph after another."""
    if len(text) <= most:
        return [text]
    out, open_, size = [], [], 0
    for p in text.split("\n\n"):
        if size + len(p) > most and open_:
            out.append("\n\n".join(open_))
            open_, size = [p], len(p)
        else:
            open_.append(p)
            size += len(p) + 2
    return [*out, "\n\n".join(open_)]


def test_chunks(spark):
    r = random.Random(1)
    texts = ["\n\n".join("x" * r.randrange(30) for _ in range(r.randrange(1, 12))) for _ in range(40)] + ["", None, " " * 200, "y" * 300]
    out = curate.chunk(docs(spark, texts), most=60).orderBy("doc_id", "chunk").collect()
    want = [(i, c) for i, t in enumerate(texts) if t for c in brute_chunks(t, 60) if c.strip()]
    assert [(x["doc_id"], x["text"]) for x in out] == want
    flagged = curate.chunk(spark.createDataFrame([("a", 1), ("b", None), ("c", 0)], "text string, branch_id int"))
    assert [(x["branch_id"], x["preserve_whitespace"]) for x in flagged.collect()] == [(1, True), (0, False), (0, False)]


@pytest.mark.parametrize("parts", [1, 7])
def test_packing(spark, parts):
    r = random.Random(2)
    rows = [(i, [i * 100 + k for k in range(r.randrange(0, 40))]) for i in range(50)]
    tokens = spark.createDataFrame(rows, "doc_id long, input_ids array<int>").repartition(parts)
    flat = [x for _, ids_ in rows for x in ids_]
    out = curate.pack(tokens, length=16).orderBy("chunk").collect()
    assert [x["input_ids"] for x in out] == [flat[i : i + 16] for i in range(0, len(flat) // 16 * 16, 16)]
    assert all(x["attention_mask"] == [1] * 16 for x in out)
    tail = curate.pack(tokens, length=16, emit_tail=True).orderBy(F.desc("chunk")).first()
    assert len(flat) % 16 == 0 or tail["input_ids"] == flat[len(flat) // 16 * 16 :]


def test_decontamination(spark):
    item = "what is the capital city of the large country in the far north of europe today"
    df = docs(spark, ["nothing to see", f"intro {item} outro", f"{' '.join(item.split()[:6])} then something else"])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert ids(curate.decontaminate(df, items, n=5, mode="drop")) == [0]
    assert ids(curate.decontaminate(df, items, n=13)) == [0, 2]
    assert ids(curate.decontaminate(df, items, n=13, mode="subsequence")) == [0, 2]
    assert ids(curate.decontaminate(df, items.limit(0))) == [0, 1, 2]


def greedy(bands):
    """Sequential first-wins over the same bands."""
    kept, gone = set(), []
    for doc_id in sorted(bands):
        if bands[doc_id] & kept:
            gone.append(doc_id)
        else:
            kept |= bands[doc_id]
    return gone


def test_greedy_equals_the_sequential_one(spark):
    r = random.Random(5)
    bands = {i: {(b, r.randrange(12)) for b in range(3)} for i in range(60)}
    df = spark.createDataFrame([(i, b, k) for i, s in bands.items() for b, k in s], "doc_id long, band int, key long").repartition(5)
    assert ids(lsh.losers(df)) == greedy(bands)


def test_fuzzy_dedup(spark):
    r = random.Random(6)
    base = " ".join(f"w{r.randrange(999)}" for _ in range(200))
    df = docs(spark, [base, base + " tail", " ".join(f"v{r.randrange(999)}" for _ in range(200)), base])
    assert 2 in ids(lsh.fuzzy_dedup(df)) and ids(lsh.fuzzy_dedup(df))[0] == 0 and 3 not in ids(lsh.fuzzy_dedup(df))


def test_structure_dedup(spark):
    one = "def total(items):\n    out = 0\n    for item in items:\n        out += item\n    return out\n"
    two = "# other words\ndef summed(values):\n    acc = 0\n    for v in values:\n        acc += v\n    return acc\n"
    three = "def other(a):\n    return [x for x in a if x]\n"
    assert ids(lsh.structure_dedup(docs(spark, [one, two, three, "# only\n", "# comments\n"]))) == [0, 2, 3]
    assert arrow.canonical(one) == arrow.canonical(two.split("\n", 1)[1])


def test_similar_pairs(spark):
    r = random.Random(7)
    texts = []
    for _ in range(12):
        base = [f"w{r.randrange(50)}" for _ in range(r.randrange(2, 30))]
        texts += [" ".join(base), " ".join(base[:-1] + ["z"]), " ".join(base)]

    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or {t}

    of = {a: min(b for b in range(len(texts)) if grams(texts[b]) == grams(texts[a])) for a in range(len(texts))}  # the first of each set stands for it
    firsts = sorted(set(of.values()))
    want = {(a, b) for a in firsts for b in firsts if a < b and len(grams(texts[a]) & grams(texts[b])) / len(grams(texts[a]) | grams(texts[b])) >= 0.8}
    want |= {(b, a) for a, b in of.items() if a != b}
    assert {(x["id_a"], x["id_b"]) for x in lsh.similar_pairs(docs(spark, texts)).collect()} == want


def test_contract(spark):
    with pytest.raises(ValueError, match="text"):
        curate.normalise(spark.range(1))


def test_language_agreement_reads_whole_texts(spark, tmp_path):
    from millrace.plans import catalog

    text = "the and of " * 140 + "der die und das ist nicht " * 200
    spark.createDataFrame([(1, text, "de")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in catalog.QUERIES["language_agreement"](spark, str(tmp_path)).collect()] == [("de", "de", 1)]


def test_byte_pairs_packed_and_written(spark, tmp_path):
    """A vocabulary of single bytes and a few merges, against plain merging."""
    import base64

    ranks = [bytes([b]) for b in range(256)] + [b"ab", b"abab", b" a"]
    (tmp_path / "v").write_bytes(b"\n".join(base64.b64encode(x) + b" " + str(i).encode() for i, x in enumerate(ranks)))
    df = spark.createDataFrame([(1, "abab a", 7), (2, None, 8), (3, "xé", 9)], "doc_id long, text string, input_ids int")
    out = curate.tokenise(df, str(tmp_path / "v"), r" ?\S+|\s+", end=999)
    rows = {r["doc_id"]: r["input_ids"] for r in out.collect()}
    assert rows == {1: [257, 258, 999], 2: [999], 3: [120, *"é".encode(), 999]}
    packed = curate.pack(out, length=2)
    assert curate.write_packed(packed, f"file://{tmp_path}/packed") == 4
    back = spark.read.parquet(f"file://{tmp_path}/packed").orderBy("chunk").collect()
    assert [r["input_ids"] for r in back] == [[257, 258], [999, 999], [120, "é".encode()[0]], ["é".encode()[1], 999]] and all(r["attention_mask"] == [1, 1] for r in back)
