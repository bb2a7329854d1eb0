import base64
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken

from millrace.llm import tokencounts
from millrace.llm.common import new_path

from .helpers import frame, odd_rows, rng


def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def totals(rollup):
    return {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in rollup.totals().collect()}


def brute(rows):
    enc, out = encoding(), defaultdict(lambda: (0, 0))
    for _, text, lang, source in rows:
        docs, tokens = out[source, lang]
        out[source, lang] = (docs + 1, tokens + len(enc.encode_ordinary(text or "")))
    return dict(out)


def changes(spark, rows):
    return spark.createDataFrame(rows, "op string, doc_id long, source string, lang string, text string, docs int, tokens int, key string")


def change(op, doc_id, text, lang="en", source="a"):
    return (op, doc_id, source, lang, text, 1, 1, "k")


def test_load_of_odd_rows(spark):
    rows = odd_rows(rng()) + [(20, "<|endoftext|> as plain text", "en", "a")]
    rows += [(100 + i, f"document {i} of some", "en", "a") for i in range(300)]  # of every class of changes
    root = new_path(spark, "r")
    out = tokencounts.corpus_totals(frame(spark, rows), root, tokencounts.public_tokenizer(spark))
    ledger = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/ledger")
    assert ledger.where("docs < 0 and source like 'draft of %'").count() and ledger.where("docs < 0 and source = 'a'").count()
    assert {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in out.collect()} == brute(rows)


def test_deltas_and_idempotent_commits(spark):
    roll = tokencounts.TokenRollup(spark, new_path(spark, "r"), tokencounts.public_tokenizer(spark))
    assert roll.totals().count() == 0
    assert roll.apply("1", changes(spark, [change("insert", 1, "one two"), change("insert", 2, "three"), change("insert", 3, "four", "de")]))
    first = totals(roll)
    assert first == brute([(1, "one two", "en", "a"), (2, "three", "en", "a"), (3, "four", "de", "a")])
    assert not roll.apply("1", changes(spark, [change("insert", 9, "never counted")])) and totals(roll) == first
    assert roll.apply("2", changes(spark, [change("revise", 1, "one two three four"), change("delete", 2, None), change("revise", 3, "four", "de"), change("delete", 77, None)]))
    assert totals(roll) == brute([(1, "one two three four", "en", "a"), (3, "four", "de", "a")])
    assert roll.apply("3", changes(spark, [change("revise", 3, "four", "fr", "b"), change("insert", 5, "")]))
    assert totals(roll) == brute([(1, "one two three four", "en", "a"), (3, "four", "fr", "b"), (5, "", "en", "a")])
    assert roll.apply("4", changes(spark, [])) and roll.apply("5", changes(spark, [change("delete", i, None) for i in (1, 3, 5)]))
    assert totals(roll) == {}


def test_files_of_an_uncommitted_attempt_do_not_count(spark):
    root = new_path(spark, "r")
    roll = tokencounts.TokenRollup(spark, root, tokencounts.public_tokenizer(spark))
    roll.apply("1", changes(spark, [change("insert", 1, "one two")]))
    before = totals(roll)
    spark.read.parquet(f"{root}/rollup/{roll.log()[0]['attempt']}").write.parquet(f"{root}/rollup/broken-attempt")
    assert totals(roll) == before and roll.batches() == {"1"}
    fs, path = roll._path("log/000000000001")
    fs.create(path, False).close()
    with pytest.raises(tokencounts.Conflict, match="is empty"):
        roll.apply("2", changes(spark, [change("insert", 2, "x")]))
    fs.delete(path, False)
    assert roll.apply("2", changes(spark, [change("insert", 2, "x")]))


def test_batches_at_once_are_serialised(spark):
    """Another writer commits while a batch is being computed: it is computed anew on the state that is then."""
    root = new_path(spark, "r")
    mine, theirs = (tokencounts.TokenRollup(spark, root, tokencounts.public_tokenizer(spark)) for _ in range(2))
    mine.apply("load", changes(spark, [change("insert", 1, "one two"), change("insert", 2, "three")]))
    write, turns = mine._write, []

    def slow(attempt, rows, log):
        write(attempt, rows, log)
        if not turns:
            assert theirs.apply("theirs", changes(spark, [change("delete", 1, None)]))
        turns.append(attempt)

    mine._write = slow
    assert mine.apply("mine", changes(spark, [change("delete", 1, None), change("revise", 2, "three four")]))
    assert len(turns) == 2 and totals(mine) == brute([(2, "three four", "en", "a")])
    assert not mine.apply("theirs", changes(spark, [])) and mine.batches() == {"load", "mine", "theirs"}


def test_compaction_changes_nothing(spark):
    root = new_path(spark, "r")
    roll = tokencounts.TokenRollup(spark, root, tokencounts.public_tokenizer(spark))
    roll.COMPACT = 3
    for i in range(5):
        assert roll.apply(str(i), changes(spark, [change("insert", i, f"text {i}"), change("delete", i - 2, None)]))
    assert len(roll.log()) <= 3 and any(e["compacted"] for e in roll.log())
    assert totals(roll) == brute([(3, "text 3", "en", "a"), (4, "text 4", "en", "a")])
    assert not roll.apply("0", changes(spark, [change("insert", 9, "again")])) and roll.batches() == set("01234")


def test_versions_are_kept_apart(spark):
    root = new_path(spark, "r")
    one = tokencounts.public_tokenizer(spark)
    two = tokencounts.public_tokenizer(spark, "byte_bpe_multi_50k.tiktoken")
    assert one.version != two.version
    tokencounts.TokenRollup(spark, root, one).apply("1", changes(spark, [change("insert", 1, "one two")]))
    tokencounts.TokenRollup(spark, root, two).apply("2", changes(spark, [change("insert", 1, "one two")]))
    assert {r["tokenizer"] for r in tokencounts.TokenRollup(spark, root, one).totals().collect()} == {one.version, two.version}
    later = tokencounts.TokenRollup(spark, root, two)
    later.apply("3", changes(spark, [change("insert", 2, "three")]))
    later.apply("4", changes(spark, [change("delete", 1, None)]))  # whatever the id has, in every version
    assert [(r["tokenizer"], r["docs"]) for r in later.totals().collect()] == [(two.version, 1)]
