"""Line dedup over overlapping three-line windows.

Consecutive lines of a document (blank ones left out) form windows of three. A window whose lines occur earlier -
in a document before it by doc_id, or further up in the same one - is a repeat; the lines that repeats cover are
merged and removed, so a passage of many lines goes as one piece while its first occurrence stays.

Defined cases: null text stays null and has no windows; texts with fewer than three non-blank lines stay as they
are; blank lines are never removed. Rows equal in doc_id and text count as one occurrence and get the same result;
rows that share a doc_id with other text are ordered by a hash of it. A null doc_id comes last. Other columns, of any name,
are carried through; ``dedup_lines`` replaces an n_lines and an n_removed. Only DataFrame functions are used. Windows are
compared by 128 bits of hash. Texts are only shuffled if the documents with repeats are too many for a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, packed, small, unpacked, written

WINDOW = 3
_BLANK_TEXT = r"\A[\x20\x09-\x0D]*\z"
_BLANK = r"^[\x20\x09-\x0D]*$"


def line_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, version, at, h1, h2): a row per window; ``at`` counts non-blank lines. ``version`` tells texts of one doc_id apart."""
    solid = F.filter(F.split("text", "\n", -1), lambda x: ~x.rlike(_BLANK))
    hashed = F.transform(solid, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))

    def window(lines, i):
        return bind(F.slice(lines, i + 1, WINDOW), lambda part: F.struct(i.alias("at"), F.xxhash64(part["a"]).alias("h1"), F.xxhash64(part["b"]).alias("h2")))

    every = bind(hashed, lambda lines: F.when(F.size(lines) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(lines) - WINDOW), lambda i: window(lines, i))))
    return docs.select("doc_id", F.xxhash64("text").alias("version"), F.inline(every))


def repeats(windows: DataFrame) -> DataFrame:
    """(doc_id, version, starts): where the repeated windows of a document begin.

    The first occurrence of a window is a minimum, pre-aggregated before the shuffle; only windows that occur twice
    are joined back, and that join's large side may be split by the engine where one window is very common.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version", "at")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    again = windows.join(firsts, ["h1", "h2"]).where(place != F.col("first"))
    return again.groupBy("doc_id", "version").agg(F.collect_set("at").alias("starts"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(row, text, n_lines, n_removed): the packed row, and its text less the repeated passages."""
    again = repeats(written(line_windows(docs), "line-windows", as_dealt=True)).select(F.col("doc_id").alias("again_id"), F.col("version").alias("again_version"), "starts")
    again = written(again, "line-repeats")
    rows = packed(docs, "doc_id", "text").withColumn("version", F.xxhash64("text"))
    joined = rows.join(small(again, again.count()), F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("version") == F.col("again_version")), "left")
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (WINDOW - 1)))))

    def left(lines: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(lines) - 1)
        solid = F.filter(numbers, lambda i: ~F.get(lines, i).rlike(_BLANK))
        gone = bind(solid, lambda at: F.transform(covered, lambda k: F.get(at, k)))
        return F.array_join(F.transform(F.array_except(numbers, gone), lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col("starts").isNull(), F.col("text")).otherwise(bind(F.split("text", "\n", -1), left))
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    n_removed = F.when(F.col("starts").isNull(), F.lit(0)).otherwise(F.size(covered))
    return joined.select("row", text.alias("text"), n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def _columns(columns: list[str]) -> list[Column]:
    return [F.col("text") if c == "text" else field for c, field in zip(columns, unpacked(columns), strict=True)]


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its text less the repeated passages, and n_lines and n_removed (replaced if they exist)."""
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return without_repeats(docs).select(*_columns(columns), "n_lines", "n_removed")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` in its own columns, repeated passages removed from its texts; rows of which no line with text is left go."""
    out = without_repeats(docs)
    return out.where((F.col("n_removed") == 0) | ~F.col("text").rlike(_BLANK_TEXT)).select(*_columns(docs.columns))


#: The same in DuckDB, on the lines themselves.
SQL = r"""
with lines as (
  select doc_id, text, line, n, not regexp_matches(line, '^[\x20\x09-\x0D]*$') as solid
  from (select doc_id, text, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as n from documents where text is not null)
), solid as (
  select *, row_number() over (partition by doc_id order by n) - 1 as pos from lines where solid
), windows as (
  select doc_id, pos, line as a, lead(line, 1) over w as b, lead(line, 2) over w as c
  from solid window w as (partition by doc_id order by pos)
), placed as (
  select doc_id, pos, row_number() over (partition by a, b, c order by doc_id, pos) as nth from windows where b is not null and c is not null
), gone as (
  select distinct doc_id, pos + k as pos from placed, (select unnest(range(3)) as k) where nth > 1
), kept as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.n) as text
  from lines l left join solid s on s.doc_id = l.doc_id and s.n = l.n left join gone g on g.doc_id = s.doc_id and g.pos = s.pos
  where g.pos is null group by l.doc_id
), counted as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
  cast(case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as integer) as n_lines,
  cast(coalesce(c.n_removed, 0) as integer) as n_removed
from documents d left join kept k on k.doc_id = d.doc_id left join counted c on c.doc_id = d.doc_id
"""
