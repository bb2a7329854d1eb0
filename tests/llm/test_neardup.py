import numpy as np

from millrace.llm import neardup
from millrace.llm.common import written as module_written
from millrace.llm.components import components
from millrace.llm.shingles import PIECE, sequence_hashes, shingle_set, word_hashes

from ..compare import same
from .helpers import frame, odd_rows, rng, sentence, shingles


def brute(rows):
    """(n_shingles, component) per row of unique ids, by every pair."""
    sets = {i: shingles(t) for i, t, *_ in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, groups, copies, words):
    """Groups of texts that differ in a few words, some beyond the threshold."""
    r, rows, n = rng(seed), [], 0
    for _ in range(groups):
        base = sentence(r, r.randrange(*words)).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(r.randrange(0, max(2, len(own) // 14))):
                own[r.randrange(len(own))] = f"w{r.randrange(9)}"
            rows.append((n, " ".join(own), "en", "a"))
            n += 1
    return rows


def check(spark, rows):
    out = neardup.near_duplicates(frame(spark, rows)).collect()
    want = brute(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out) and len(out) == len(rows)


def test_long_and_short_texts(spark):
    check(spark, near_copies(1, 12, 8, (60, 300)) + [(i + 10_000, t, s, x) for i, t, s, x in near_copies(2, 30, 6, (1, 45))])


def test_one_large_group(spark):
    check(spark, near_copies(5, 1, 150, (120, 121)))


def test_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 900)
    monkeypatch.setattr(neardup, "PART", 500)
    check(spark, near_copies(6, 2, 60, (100, 130)))


def test_odd_rows(spark):
    rows = odd_rows(rng())
    out = neardup.near_duplicates(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in out if not r["n_shingles"]} == {(None, None, True), (1, 1, True), (2, 2, True), (3, 3, True)}
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    stays = neardup.drop_near_duplicates(frame(spark, rows))
    assert stays.count() == len(rows) and stays.columns == frame(spark, rows).columns


def test_upper_case_ascii_only(spark):
    rows = [(1, "One Two Three FOUR five six", "en", "a"), (2, "one two three four FIVE six", "en", "a"), (3, "É one two three four five", "en", "a"), (4, "é one two three four five", "en", "a")]
    out = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4}


def test_word_hashes_in_pieces():
    text = ("word " * (PIECE // 4) + "x" * (2 * PIECE) + " tail é ß\tend").encode()
    whole = word_hashes(text)
    assert len(whole) == PIECE // 4 + 1 + 3
    assert len(set(whole.tolist())) == 5
    again = word_hashes(b"\n" + text)
    assert np.array_equal(whole, again)
    assert len(sequence_hashes(whole[:3], 5)) == 1 and not len(shingle_set("  ")) and not len(shingle_set(None))


def test_estimate_is_close():
    r = np.random.default_rng(3)
    for share in (0.5, 0.75, 0.9):
        one = np.unique(r.integers(0, 2**64, 4000, dtype=np.uint64))
        keep = int(len(one) * 2 * share / (1 + share))
        two = np.unique(np.concatenate([one[r.permutation(len(one))[:keep]], r.integers(0, 2**64, len(one) - keep, dtype=np.uint64)]))
        a, b = neardup.registers(one), neardup.registers(two)
        equal = ((a == b) & (a > 0)).sum() / ((a > 0) | (b > 0)).sum()
        assert abs(equal - share) < 0.12


def test_columns_of_any_name_come_through(spark):
    names = ["__id", "__version", "version", "row", "gone_id", "label", "n_shingles", "kept", "a.b"]
    docs = frame(spark, near_copies(1, 4, 4, (60, 90))).select("doc_id", "text")
    plain = {r["doc_id"] for r in neardup.drop_near_duplicates(docs).collect()}
    for k, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] * 10 + k)
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == plain
    assert all(r[name] == r["doc_id"] * 10 + k for r in out.collect() for k, name in enumerate(names))


def test_outsiders_of_a_large_group_are_found_in_small_blocks(spark, monkeypatch):
    """Several groups over one passage, so that buckets hold many components."""
    monkeypatch.setattr(neardup, "BLOCK", 500)
    monkeypatch.setattr(neardup, "PART", 300)
    r, rows = rng(9), []
    base = sentence(r, 200).split()
    for group in range(8):
        own = base[:120] + sentence(r, 80).split()
        for copy in range(30 if group == 0 else 5):
            words = list(own)
            words[r.randrange(200)] = "changed"
            rows.append((len(rows), " ".join(words), "en", "a"))
    check(spark, rows)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from millrace.llm import components as module

    turns = []
    monkeypatch.setattr(module, "FEW", 3)
    monkeypatch.setattr(module, "written", lambda df, name, **kw: turns.append(name) or module_written(df, name, **kw))
    chain = spark.range(600).selectExpr("id as a", "id + 1 as b")
    assert {r["label"] for r in module.components(chain).collect()} == {0}
    assert turns.count("links") < 20


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (4, 4)], "a long, b long")
    assert {(r["node"], r["label"]) for r in components(links).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (7, 5), (8, 5), (9, 5)}
    assert components(links.limit(0)).count() == 0


def test_sql(spark, sf_dir, duck):
    out = neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id", "kept")
    same(out, duck, neardup.SQL)
