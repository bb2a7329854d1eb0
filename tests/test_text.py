"""Text expressions against plain Python, at their boundaries."""

import hashlib
import re
import struct
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import arrow, text as tx


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", fn(tx.text("v")).alias("x")).orderBy("i").collect()]


def normal(s):
    s = re.sub("[\x00-\x08\x0b-\x1f\x7f\u200b\u200c\u00ad\ufffd]", "", s or "")
    s = re.sub(r"\b([A-Za-z]{2,})-\s*\n\s*([A-Za-z]{2,})\b", r"\1\2", s)
    return unicodedata.normalize("NFKC", s)


NORMAL = ["an exam-\n  ple here", "well-known", "cafe\u0301 \ufb01le", "zero\u200bwidth\x00\n", "", None, "cr\r\nlf\x0b", "\u00e9tat-\nun", "a-\nb", "x\u00ad-\ny zz-\nyy", "-\n"]


def test_normalise(spark):
    assert apply(spark, lambda t: arrow.nfkc(tx.dehyphenate(tx.strip_controls(t))), NORMAL) == [normal(v) for v in NORMAL]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab-\n \t\u00e9\u200b\x00\ufb01Z", max_size=30), min_size=1, max_size=20))
def test_normalise_any(spark, values):
    assert apply(spark, lambda t: arrow.nfkc(tx.dehyphenate(tx.strip_controls(t))), values) == [normal(v) for v in values]


def test_boilerplate(spark):
    values = ["CONFIDENTIAL - internal use only\nBody text.\nDraft copy", "<html><script>var x = 1;</script><p>Keep</p><STYLE>\na{}</STYLE></html>", "page 3 of 4\n\n \t\nnext", "Copyright (c) 2024 Some Co. kept", "<>kept", "\u00e9page 3 of 4\u00e9", "", None]
    assert apply(spark, tx.strip_boilerplate, values) == ["Body text.", "Keep", "next", "kept", "<>kept", "\u00e9\u00e9", "", ""]


def test_code_density_at_its_boundary(spark):
    assert apply(spark, tx.is_code_heavy, ["{" + "x" * 19, "{" + "x" * 20, "", ";;;;"]) == [True, False, False, True]


def test_symbol_density(spark):
    assert apply(spark, tx.symbol_density, ["a -> b", "", " \n", "[x]=1;"]) == [pytest.approx(2 / 4), 0.0, 0.0, pytest.approx(4 / 6)]


def test_ratios(spark):
    t = "The cat, and the dog. a #1 that THE end"
    assert apply(spark, tx.punctuation_ratio, [t, ""]) == [pytest.approx(2 / 10), 0.0]
    assert apply(spark, tx.symbol_ratio, [t, ""]) == [pytest.approx(1 / 10), 0.0]
    assert apply(spark, tx.stop_word_ratio, [t, " the the "]) == [pytest.approx(5 / 10), pytest.approx(1 / 4)]


def top_share(text):
    words = text.lower().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return max(map(grams.count, grams)) / len(grams) if len(words) >= 15 else 0.0


def test_repetition(spark):
    values = ["a b c " * 6, "w " * 14, " ".join(map(str, range(20))), "x y z " * 5 + "\u00a0 q", ""]
    assert apply(spark, tx.top_gram_share, values) == [pytest.approx(top_share(v)) for v in values]


def test_signature(spark):
    values = ["", "abc", "\u00e9\u00df\U0001f600", "x" * 1000, None]
    assert apply(spark, tx.content_signature, values) == [struct.unpack("<q", hashlib.md5((v or "").encode()).digest()[:8])[0] for v in values]


def test_tokens_and_ngrams(spark):
    assert apply(spark, tx.tokens, [" A\u00a0b\tC  d\n", ""]) == [["a", "b", "c", "d"], []]
    assert apply(spark, tx.alnum_tokens, ["It's a_b-c, \u00c9!"]) == [["it", "s", "a_b", "c", "\u00e9"]]
    assert apply(spark, lambda t: tx.ngrams(tx.tokens(t), 3), ["a b c d", "a b"]) == [["a b c", "b c d"], []]
    assert len(apply(spark, lambda t: tx.ngrams(tx.alnum_tokens(t), 13), [" ".join(map(str, range(15)))])[0]) == 3


def test_paragraphs_lines_snippets(spark):
    assert apply(spark, tx.paragraphs, ["a\nb\n \n c \n\n\n", ""]) == [["a\nb", "c"], []]
    assert apply(spark, tx.solid_lines, [" a \n\n b", ""]) == [["a", "b"], []]
    assert apply(spark, tx.code_snippets, ["x ```py\na``` y <pre><code>b</code></pre>", "none"]) == [["py\na", "b"], ["none"]]
    assert apply(spark, tx.strip_comments, ['"""doc"""\nx = 1  # why\n\n\ny = \'#\'', "'''a\nb'''"]) == ["x = 1  \ny = '", ""]
    assert apply(spark, tx.longest_line, ["ab\nabc", ""]) == [3, 0]


def test_dangling_ends(spark):
    values = ["x = 1", "x =", "if a:\n", "f(a,  ", "", " \n", "a &&", "a != "]
    assert apply(spark, tx.dangling_end, values) == [False, True, True, True, False, False, True, True]


def test_redaction(spark):
    assert apply(spark, tx.redact, ["Mail a.b@c.org or +1 (212) 555-0100 from 10.0.0.1, card 4111 1111 1111 1111, 123-45-6789"]) == ["Mail [EMAIL_ADDRESS] or [PHONE_NUMBER] from [IP_ADDRESS], card [CREDIT_CARD], [US_SSN]"]


def test_final_numbers(spark):
    values = ["so #### 42", "costs $1,250.50 in all", "minus -15.4", "none", "#### none but 7", "#### 1 #### 2 apples", ""]
    assert apply(spark, tx.final_number, values) == ["42", "1250.50", "-15.4", None, "7", "2", None]
    df = spark.createDataFrame([("100000", "100000.9"), ("1", "1.1"), (" Yes", "yes"), (None, "1"), ("0", "0")], "a string, b string")
    assert [r[0] for r in df.select(tx.numbers_match(F.col("a"), F.col("b"))).collect()] == [True, False, True, False, True]


def test_json(spark):
    values = ['{"a": 1, "b": null}', '{"a": 1}', "[1]", "{", "", "5"]
    assert apply(spark, lambda t: tx.json_has_keys(t, ["a", "b"]), values) == [True, False, False, False, False, False]
    assert apply(spark, lambda t: tx.unfence(t, "json"), ["x ```json\n{}\n``` y", "a ``` b ``` c", " plain "]) == ["{}", "b", "plain"]


def test_judges(spark):
    values = ['{"winner": "Candidate 1", "critique": "x"}', 'so:\n```json\n{"winner": "I say Candidate 2!"}\n```', "candidate  1 is better than Candidate 2", "I prefer CANDIDATE 2", "neither", '{"winner": "both"}', '{"critique": "Candidate 1"}', ""]
    assert apply(spark, tx.judge_winner, values) == ["Candidate 1", "Candidate 2", "Candidate 1", "Candidate 2", "Tie", "Tie", "Tie", "Tie"]


def test_syntax(spark):
    assert apply(spark, lambda t: arrow.syntax_valid(t), ["def f(x):\n    return x", "def f(x)\n  return", "SELECT a FROM t WHERE b = 'x;y';", "SELECT (a FROM t", "hello there"]) == [True, False, True, False, False]
    assert arrow.canonical("def f(a):\n    return a + 1") == arrow.canonical("def g(b):\n    return b + 1") != arrow.canonical("def g(b):\n    return b + 2")
    assert arrow.complexity("x = 1") == 0 and arrow.complexity("def f(x): return x") == 1 and arrow.complexity("def f(") == 10
    assert arrow.complexity("def f(x):\n    if x and x > 1:\n        return 1\n    for y in x: pass\n") == 4
    assert apply(spark, tx.lexer_error_ratio, ["", "x = 1", "a $ b", "'open", "$$$$"]) == [0.0, 0.0, 0.2, 0.5, 1.0]


GOOD_SQL = [
    "SELECT a, b AS c FROM t WHERE x = 'it''s' AND y IN (1, 2) ORDER BY a DESC NULLS LAST LIMIT 5;", "select count(*) filter (where a > 1), sum(x) over (partition by y order by z) from s.t u left join v using (id)",
    "WITH r AS (SELECT 1 UNION ALL SELECT 2) SELECT * FROM r, (VALUES (1, 'a')) AS w(x, y) WHERE EXISTS (SELECT 1 FROM q WHERE q.id = r.id)", "INSERT INTO t (a, b) VALUES (1, NULL), (2, DEFAULT)", "UPDATE t SET a = a + 1, b = lower(b) WHERE id BETWEEN 1 AND 9 RETURNING id",
    "DELETE FROM t WHERE d < date '2020-01-01' -- old ones", "CREATE TABLE IF NOT EXISTS t (id bigint PRIMARY KEY, x numeric(10, 2) DEFAULT 0, CHECK (x > 0)); DROP TABLE IF EXISTS u", "SELECT CASE WHEN a IS NOT NULL THEN a::text ELSE CAST(b AS varchar(9)) END FROM t GROUP BY 1 HAVING max(c) > 3",
    "SELECT extract(year from d), a[1], -x * (y + 2) FROM t WHERE NOT a LIKE 'x%' OR b NOT IN (SELECT b FROM u)", "CREATE VIEW v AS SELECT 1", "(SELECT 1) UNION (SELECT 2) ORDER BY 1",
]
BAD_SQL = ["", "  ;", "hello there", "SELECT", "SELECT a FROM", "SELECT a FROM t WHERE", "SELECT (a FROM t", "SELECT a b c FROM t", "SELECT a,, b FROM t", "INSERT t VALUES (1", "UPDATE t a = 1", "DELETE t", "SELECT 'open FROM t", "SELECT a FROM t GROUP a", "def f(x): return x +", "SELECT a FROM t SELECT b FROM u", "select a from t left u on x = y", "CREATE TABLE t (a int"]


def test_sql_subset():
    assert [s for s in GOOD_SQL if not arrow.sql_valid_text(s)] == []
    assert [s for s in BAD_SQL if arrow.sql_valid_text(s)] == []
    assert not arrow.sql_valid_text("select " + "(" * 5000) and arrow.sql_valid_text("select " + "(" * 20 + "1" + ")" * 20)


def brute_substring(a, b):
    return max((j - i for i in range(len(a)) for j in range(i + 1, len(a) + 1) if a[i:j] in b), default=0)


def brute_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@given(st.text(alphabet="abc", max_size=14), st.lists(st.text(alphabet="abcd", max_size=14), max_size=3))
def test_common_parts(a, others):
    passages = arrow.Passages(others)
    for k in range(1, 9):
        assert passages.shares(a, k) == any(brute_substring(a, b) >= k for b in others)
    for b in others:
        assert arrow.common_subsequence(a, b) == brute_subsequence(a, b)
