from collections import defaultdict

import corpus_pipeline
from millrace.llm import queries

from .helpers import WORDS, frame, odd_rows, rng
from .test_decontaminate import brute as brute_leaks
from .test_langid import corpus as texts
from .test_linededup import brute as brute_lines
from .test_mixing import brute_targets
from .test_neardup import brute as brute_near


def docs_dir(spark, tmp_path, rows, items):
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_one_by_one_against_brute_force(spark, tmp_path):
    r = rng(8)
    rows = [(i, t.replace(" dog ", "\n"), lang, f"s{i % 3}") for i, t, lang, _ in texts(60)]
    passage = "\n".join(f"line {k} {r.random()}" for k in range(4))
    item = " ".join(f"b{r.randrange(999)}" for _ in range(20))
    rows += [(100, f"intro the\n{passage}", "en", "s0"), (101, f"other start\n{passage}\nand an end of it", "en", "s0"), (102, f"the words before {item} and after", "en", "s1"), (103, rows[0][1], "en", "s1"), (104, "123", "en", "s1"), (105, None, "en", "s1")]
    where = docs_dir(spark, tmp_path, rows, [(1, item)])
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs, plain = spark.read.parquet(f"{where}/documents.parquet"), lambda df: sorted((x["doc_id"], x["text"], x["lang"], x["source"]) for x in df.collect())
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language id", "line dedup", "near duplicates", "decontamination", "source mixing"]
    one = corpus_pipeline.STAGES[0][1](spark, docs, where)
    assert {x["doc_id"] for x in one.collect()} == {x[0] for x in rows} - {104, 105} and one.columns == columns
    kept = plain(one)
    two = corpus_pipeline.STAGES[1][1](spark, one, where)
    want = brute_lines(kept)
    assert {x["doc_id"]: x["text"] for x in two.collect()} == {i: t for i, (t, n) in want.items() if t.strip() or not n} and two.columns == columns
    kept = plain(two)
    three = corpus_pipeline.STAGES[2][1](spark, two, where)
    assert {x["doc_id"] for x in three.collect()} == {i for i, (_, c) in brute_near(kept).items() if i == c} and three.columns == columns
    kept = plain(three)
    four = corpus_pipeline.STAGES[3][1](spark, three, where)
    assert {x["doc_id"] for x in four.collect()} == {x[0] for x in kept} - {d for d, _ in brute_leaks(kept, [(1, item)])} and four.columns == columns
    five = corpus_pipeline.STAGES[4][1](spark, four, where)
    taken = five.collect()
    assert five.columns == [*columns, "epoch"]
    kept, sizes, words, times = plain(four), defaultdict(int), defaultdict(int), defaultdict(list)
    for _, text, _, source in kept:
        sizes[source] += len(WORDS.findall(text))
    for x in taken:
        words[x["source"]] += len(WORDS.findall(x["text"]))
        times[x["doc_id"]].append(x["epoch"])
    longest = max(len(WORDS.findall(x[1])) for x in kept)
    targets = brute_targets(dict(sizes))
    assert all(abs(words[s] - target) <= longest for s, target in targets.items())  # the last document is given whole or not at all
    assert all(sorted(e) == list(range(len(e))) and len(e) <= 3 for e in times.values())
    whole = {s: int(targets[s] // n) for s, n in sizes.items() if n}
    assert all(len(times[i]) in (whole[s], whole[s] + 1) for i, text, _, s in kept if WORDS.search(text))


def test_run_on_odd_rows_and_on_nothing(spark, tmp_path):
    where = docs_dir(spark, tmp_path / "a", odd_rows(rng()) + [(i + 1000, *x) for i, *x in texts(40)], [(1, None)])
    assert corpus_pipeline.run(spark, where).count() > 0
    assert corpus_pipeline.run(spark, docs_dir(spark, tmp_path / "b", [], [])).count() == 0


def test_each_operator_has_its_query():
    assert [name.split("_")[0] for name in queries.QUERIES if name.startswith("op")] == [f"op{n}" for n in range(1, 11)]
