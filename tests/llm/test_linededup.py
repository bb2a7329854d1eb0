from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.llm import linededup

from ..compare import same
from .helpers import frame, odd_rows, rng


def brute(rows):
    """(text, removed) per row of unique ids, by looking at windows one after another."""
    seen, out = set(), {}
    for doc_id, text, *_ in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        lines = text.split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
        gone = set()
        for k in range(len(solid) - 2):
            window = tuple(lines[i] for i in solid[k : k + 3])
            if window in seen:
                gone |= set(solid[k : k + 3])
            seen.add(window)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "", "d d", " "]), max_size=12), min_size=1, max_size=6))
def test_against_brute_force(spark, texts):
    rows = [(i, "\n".join(lines), "en", "s") for i, lines in enumerate(texts)]
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert out == brute(rows)


def test_odd_rows(spark):
    docs = frame(spark, odd_rows(rng()))
    out = linededup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted(map(repr, (r["text"] for r in out.collect()))) == sorted(map(repr, (r["text"] for r in docs.collect())))
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    passage = "one\ntwo\nthree\nfour"
    rows = [(7, passage, "en", "a"), (7, passage, "en", "a"), (None, passage, "en", "a"), (8, f"x\n{passage}\ny", "en", "a"), (7, f"{passage}\n{passage}", "en", "a")]
    out = sorted((str(r["doc_id"]), r["text"]) for r in linededup.dedup_lines(frame(spark, rows)).collect())
    assert ("8", "x\ny") in out and ("None", "") in out
    assert [t for i, t in out if i == "7"].count(passage) in (2, 3)  # the first of its id, and its repetition


def test_stage_drops_what_is_left_blank(spark):
    rows = [(1, "a\nb\nc", "en", "s"), (2, "a\nb\nc", "en", "s"), (3, "", "en", "s")]
    out = linededup.drop_repeated_lines(frame(spark, rows))
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    assert out.columns == frame(spark, rows).columns


def test_sql(spark, sf_dir, duck):
    out = linededup.dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text", "n_lines", "n_removed")
    same(out, duck, linededup.SQL)


def test_columns_of_any_name_come_through(spark):
    passage = "\n".join(f"line {k} of it" for k in range(4))
    docs = spark.createDataFrame([(1, passage), (2, f"start\n{passage}"), (3, passage)], "doc_id long, text string")
    names = ["__id", "__version", "version", "row", "starts", "again_id", "n_lines", "n_removed", "a.b"]
    for k, name in enumerate(names):
        docs = docs.withColumn(name, docs["doc_id"] * 10 + k)
    out = linededup.drop_repeated_lines(docs)
    rows = out.collect()
    assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in rows} == {1: passage, 2: "start"}
    assert all(r[name] == r["doc_id"] * 10 + k for r in rows for k, name in enumerate(names))
