import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import langid

from .helpers import frame, odd_rows, rng

LINES = {
    "en": "the quick brown fox jumps over the lazy dog and then it goes on through the wood with a friend",
    "de": "der schnelle braune fuchs springt über den faulen hund und dann geht er durch den wald mit einem freund",
    "fr": "le rapide renard brun saute par dessus le chien paresseux et puis il va dans la forêt avec un ami",
    "el": "η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και μετά πηγαίνει στο δάσος",
}


def corpus(n=240):
    r = rng(4)
    rows = []
    for i in range(n):
        lang = list(LINES)[i % 4]
        words = LINES[lang].split()
        rows.append((i, " ".join(r.choice(words) for _ in range(r.randrange(5, 40))), lang, "s"))
    return rows


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    rows = corpus()
    out = langid.identify(frame(spark, rows)).collect()
    known = {r[0]: r[2] for r in rows}
    assert all(r["held_out"] == held(r["doc_id"]) for r in out) and len(out) == len(rows)
    aside = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in aside) >= 0.95 * len(aside)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, t, "xx" if held(i) else lang, s) for i, t, lang, s in corpus()]
    assert "xx" not in {r["lang_pred"] for r in langid.identify(frame(spark, rows)).collect()}


def test_odd_rows(spark):
    rows = [(i + 100, *r) for i, *r in corpus(80)] + odd_rows(rng()) + [(50, "123 456 !!", "en", "a")]
    out = langid.identify(frame(spark, rows)).where("doc_id < 100 or doc_id is null").collect()
    und = [r for r in out if r["lang_pred"] == "und"]
    assert len(und) == 5 and all(r["score"] == 0 for r in und)
    assert all(r["held_out"] for r in out if r["doc_id"] is None)
    kept = langid.keep_identified(frame(spark, rows), least=0.0)
    assert kept.columns == frame(spark, rows).columns and kept.count() == len(rows) - 5


def test_nothing_to_learn_from(spark):
    assert {r["lang_pred"] for r in langid.identify(frame(spark, [(1, "some text", None, "a")])).collect()} == {"und"}
    assert langid.identify(frame(spark, [])).count() == 0


def test_one_language(spark):
    out = langid.identify(frame(spark, [(i, "some text", "en", "a") for i in range(10)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("en", 1.0)}


def test_document_frequencies(spark):
    docs = frame(spark, [(1, "aa", "en", "a"), (2, "a b", "en", "a"), (3, "..", "en", "a"), (4, None, "en", "a")])
    df, n = langid.document_frequencies(docs)
    counts = [langid.gram_counts(t) for t in ("aa", "a b")]
    assert n == 2 and np.array_equal(df, sum((c > 0).astype(np.int64) for c in counts))


def test_counts_against_plain_strings(monkeypatch):
    """Every n-gram of the cleaned text, however it is cut in pieces."""
    import re

    monkeypatch.setattr(langid, "PIECE", 7)
    for text in ("Ab, cd  e!", "  x", "ΣΑΣ καὶ ΟΔΟΣ", "one-letter-words-and-averyveryverylongword", "a𐐀b 𐐁", "z"):
        clean = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
        want = np.zeros(langid.DIMENSIONS, np.int64)
        for n in (1, 2, 3):
            for i in range(len(clean) - n + 1):
                gram = clean[i : i + n]
                if gram.strip():
                    c = np.array([0 if x == " " else ord(x) for x in gram], np.uint32)
                    want[_feature(c)] += 1
        assert np.array_equal(langid.gram_counts(text), want), text
    assert langid.gram_counts(" 12 ") is None


def _feature(c):
    """One n-gram's feature number, by whole-number arithmetic."""
    m = (1 << 32) - 1
    c = [int(x) for x in c]
    a = [x * 2654435761 & m for x in c]
    b = [(x * 2246822519 + 374761393) & m for x in c]
    d = [(x * 3266489917 + 668265263) & m for x in c]
    h = a[0] if len(c) == 1 else a[0] ^ b[1] if len(c) == 2 else ((a[0] ^ b[1]) * 2654435769 & m) ^ d[2]
    h ^= h >> 15
    return (h * 2246822507 & m) >> 16


def plain_ftrl(data, features, classes, order, alpha, beta, l1, l2):
    """Follow-the-regularised-leader, a coordinate at a time."""
    import math

    z, n = {}, {}

    def weight(i, k):
        x = z.get((i, k), 0.0)
        return 0.0 if abs(x) <= l1 else -(x - math.copysign(l1, x)) / ((beta + math.sqrt(n.get((i, k), 0.0))) / alpha + l2)

    for at in order:
        rows, x, label = data[at]
        w = {(i, k): weight(i, k) for i in rows for k in range(classes)}
        u = [sum(v * w[i, k] for i, v in zip(rows, x, strict=True)) for k in range(classes)]
        e = [math.exp(v - max(u)) for v in u]
        for k in range(classes):
            p = e[k] / sum(e) - (k == label)
            for i, v in zip(rows, x, strict=True):
                g, old = v * p, n.get((i, k), 0.0)
                z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[i, k]
                n[i, k] = old + g * g
    return np.array([[weight(i, k) for k in range(classes)] for i in range(features)])


def test_learner_and_temperature_against_plain_arithmetic(monkeypatch):
    import math

    monkeypatch.setattr(langid, "DIMENSIONS", 12)
    r = np.random.default_rng(3)
    rows = [(("aa", "bb", "cc")[i % 3], np.sort(r.choice(12, 4, replace=False)).astype(np.int32), r.integers(1, 9, 4).astype(np.int32)) for i in range(30)]
    idf = r.random(12) + 1
    model = langid.fit(rows, idf, epochs=2, seed=5)
    data = []
    for lang, f, c in rows:
        x = [math.log1p(n) * idf[i] for i, n in zip(f, c, strict=True)]
        size = math.sqrt(sum(v * v for v in x))
        data.append(([*map(int, f), 12], [float(np.float32(v / size)) for v in x] + [1.0], ("aa", "bb", "cc").index(lang)))
    kept, aside = [d for i, d in enumerate(data) if i % 6], [d for i, d in enumerate(data) if i % 6 == 0]
    g = np.random.default_rng(5)
    order = [i for _ in range(2) for i in g.permutation(len(kept))]
    w = plain_ftrl(kept, 13, 3, order, 2.0, 1.0, 0.02, 0.05)
    assert np.allclose(model.weights, w[:12], atol=1e-5) and np.allclose(model.bias, w[12], atol=1e-5)
    assert ((model.weights == 0) == (w[:12] == 0)).all()

    def loss(t):
        total, doubt = 0.0, 1 / (len(aside) + 2)
        for f, x, label in aside:
            u = [sum(v * w[i, k] for i, v in zip(f, x, strict=True)) / t for k in range(3)]
            top = max(u)
            for k in range(3):
                log_p = u[k] - top - math.log(sum(math.exp(v - top) for v in u))
                total -= log_p * ((1 - doubt) if k == label else doubt / 2)
        return total

    assert model.temperature == min((0.05 * 1.15**k for k in range(43)), key=loss)


def test_workers_need_no_copy_of_the_package(spark):
    """What travels names no class of the package."""
    import pickle
    import pickletools

    model = langid.Model(["aa"], np.ones(4), np.ones((4, 1), np.float32), np.zeros(1), 1.0)
    strings = [arg for _, arg, _ in pickletools.genops(pickle.dumps(model.parts())) if isinstance(arg, str)]
    assert not any("millrace" in s for s in strings)


def test_more_languages_than_the_sample_and_repeated_ids(spark):
    rows = [(i, f"text of number {i} here", f"l{i:02d}", "a") for i in range(40)]
    docs = frame(spark, rows)
    one, two = (langid.sample_features(d, 10, 1) for d in (docs, docs.repartition(9)))
    assert len(one) == 10 and [x[0] for x in one] == [x[0] for x in two]
    again = frame(spark, [(7, f"text {'x' * (i % 50)} here", "en", "a") for i in range(200)])
    assert len(langid.sample_features(again, 20, 1)) == 20


def test_sample_is_bounded(spark):
    docs = frame(spark, corpus(200)).where(F.col("lang").isNotNull())
    assert len(langid.sample_features(docs, 40, 1)) == 40


def test_texts_travel_to_the_workers_once(spark):
    """Beside a packed row no copy of its text is sent to Python and back."""
    kept = langid.keep_identified(frame(spark, [(i, "some words of a text", "en", "a") for i in range(20)]), least=0.0)
    found = [kept._jdf.queryExecution().analyzed()]
    while found[0].nodeName() != "MapInArrow":
        found = [found[0].children().head()]
    assert found[0].children().head().output().size() == 1
    assert kept.count() == 20


def test_columns_of_any_name_come_through(spark):
    docs = frame(spark, corpus(80)).select("doc_id", "text", "lang")
    names = ["lang_pred", "score", "__score", "row", "h", "version", "a.b"]
    for k, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] * 10 + k)
    out = langid.keep_identified(docs, least=0.0)
    rows = out.collect()
    assert out.columns == docs.columns and len(rows) == 80 and all(r[name] == r["doc_id"] * 10 + k for r in rows for k, name in enumerate(names))
