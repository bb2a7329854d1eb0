from collections import Counter

from pyspark.sql.functions import col as df_col

from millrace.llm import decontaminate

from ..compare import same
from .helpers import WORDS, frame, odd_rows, rng, sentence


def grams(text):
    words = [w.lower() for w in WORDS.findall(text or "")]
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute(docs, items):
    """(doc_id, item_id) -> best similarity over every window."""
    out = {}
    for doc_id, text, *_ in docs:
        mine = grams(text)
        for item_id, item in items:
            own = grams(item)
            if not own or not mine:
                continue
            want, best = Counter(own), 0.0
            for start in range(0, max(1, len(mine) - len(own) + 1), max(1, len(own) // 128)):
                have = Counter(mine[start : start + len(own)])
                common = sum((have & want).values())
                best = max(best, common / (sum(have.values()) + len(own) - common))
            if best >= 0.75:
                out[doc_id, item_id] = round(best, 9)
    return out


def corpus():
    r = rng(11)
    items = [(i, sentence(r, r.randrange(8, 60))) for i in range(12)] + [(100, "loop the loop the loop the loop the loop the loop"), (101, "two words"), (102, ""), (103, None)]
    docs = []
    for n in range(60):
        words = sentence(r, r.randrange(0, 120)).split()
        if n % 2:
            leak = items[r.randrange(13)][1].split()
            for _ in range(r.randrange(3)):
                k = r.randrange(len(leak))
                leak[k : k + r.randrange(2)] = ["changed"] * r.randrange(2)
            at = r.randrange(len(words) + 1)
            words[at:at] = leak
        docs.append((n, " ".join(words), "en", "a"))
    return docs, items


def run(spark, docs, items):
    return decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))


def test_against_every_window(spark):
    docs, items = corpus()
    out = run(spark, docs, items).collect()
    want = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in out} == want
    assert len(want) > 10


def test_stage_drops_what_holds_an_item(spark):
    docs, items = corpus()
    frame_ = frame(spark, docs)
    out = decontaminate.drop_contaminated(frame_, spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in out.collect()} == {d[0] for d in docs} - {d for d, _ in brute(docs, items)}
    assert out.columns == frame_.columns


def test_odd_rows(spark):
    rows, item = odd_rows(rng()), "no id but text of some words"
    out = run(spark, rows, [(None, item), (None, item), (5, item)]).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(None, None), (None, 5)}
    assert run(spark, [], [(1, item)]).count() == 0
    assert run(spark, rows, []).count() == 0
    left = decontaminate.drop_contaminated(frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.count() == len(rows) - 1


def test_blocks_cover_the_radius():
    near = {m for m in range(256) if m.bit_count() <= decontaminate.NEAR}
    assert len(near) == 37
    assert decontaminate.RADIUS < decontaminate.BLOCKS * (decontaminate.NEAR + 1)


def test_sql(spark, sf_dir, duck):
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    out = decontaminate.contaminated(read("documents"), read("benchmark")).select("doc_id", "item_id", "similarity", "start", "n_words", "n_windows")
    same(out, duck, decontaminate.SQL)


def test_items_that_repeat_a_shingle(spark):
    r, items, docs = rng(5), [], []
    for n in range(12):  # 200 shingles, 24 of them one; the window has 172 of the others
        words = [f"i{n}x{k}" for k in range(176)]
        items.append((n, " ".join([*words, *["____"] * 28])))
        docs.append((n, " ".join([*words, *sentence(r, 28).split()]), "en", "a"))
    want = brute(docs, items)
    assert len(want) == len(items)
    assert {(x["doc_id"], x["item_id"]): round(x["similarity"], 9) for x in run(spark, docs, items).collect()} == want


def test_items_of_any_length(spark):
    """Counters that no 16 bits hold, windows that aren't the item's square, and a shingle that repeats thousands of times."""
    r = rng(6)
    long, dull = sentence(r, 33_000, 1_000_000), "so it goes and goes on " * 90
    middling = sentence(r, 700, 100_000)
    items = [(1, long), (2, dull), (3, middling)]
    changed = middling.split()
    changed[100:180] = sentence(r, 80).split()
    docs = [(1, f"a few words before {long} and after", "en", "a"), (2, f"{sentence(r, 501)} {dull} end", "en", "a"), (3, f"{sentence(r, 333)} {' '.join(changed)} {sentence(r, 9)}", "en", "a"), (4, sentence(r, 3000), "en", "a")]
    out = {(x["doc_id"], x["item_id"]): round(x["similarity"], 9) for x in run(spark, docs, items).collect()}
    assert set(out) == {(1, 1), (2, 2), (3, 3)} and out[1, 1] > 0.98
    assert {k: v for k, v in out.items() if k != (1, 1)} == brute(docs[1:], items[1:])


def test_tags_tell_occurrences_apart(spark):
    rows = [([5, 7, 5, 5, 9, 7],), ([3] * 5000,), ([1, 2, 3],), ([],)]
    df = spark.createDataFrame(rows, "sh array<bigint>").select("sh", decontaminate.tagged(df_col("sh")).alias("t"))
    for r in df.collect():
        assert len(set(r["t"])) == len(r["sh"]) == len(r["t"])
    a, b = (spark.createDataFrame([(x,)], "sh array<bigint>").select(decontaminate.tagged(df_col("sh"))).first()[0] for x in ([4, 4, 6, 4], [6, 4, 8, 4]))
    assert len(set(a) & set(b)) == 3


def test_columns_of_any_name_come_through(spark):
    docs, items = corpus()
    names = ["__id", "__version", "version", "row", "bad_id", "n", "start", "a.b"]
    plain = decontaminate.drop_contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    wide = frame(spark, docs).select("doc_id", "text")
    for k, name in enumerate(names):
        wide = wide.withColumn(name, df_col("doc_id") * 10 + k)
    out = decontaminate.drop_contaminated(wide, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == wide.columns and {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in plain.collect()}
