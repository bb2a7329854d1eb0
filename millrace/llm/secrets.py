"""Secret scans: fixed patterns, and values in a credential context judged by how many guesses they would take.

Fixed patterns find assignments of passwords and tokens, access keys and long hexadecimal strings. Every value that follows
a credential word, those of the fixed patterns too, is costed: its cheapest segmentation into words, dates, repeats, keyboard
walks and brute-force spans gives the power of ten of guesses needed. Values that no fixed pattern covers and that need at
least ``threshold`` are added as secrets, whatever they consist of; what the others need is told beside their spans. After
"is", letters in a word's case (the secret is something) need twice that power. A value that isn't accepted may hold a
credential word itself; the search goes on from its start.

Words are ranked: common passwords first, then the corpus's own words by the number of documents that hold them. They are
counted over all texts, without what stands in a credential context, so that a secret that is copied often isn't learnt.

Defined cases: null and empty texts have no spans; ties start for start are told apart by kind; texts and values of
any length are scanned whole (segments are at most ``LONGEST`` characters, so time is linear in a value's length).
Positions are code points. Every row is judged alone; repeated rows get equal results; other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")
#: The patterns of the contract. Letters of the first in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of at least 32 is what is left of [0-9a-f]+ once shorter ones are dropped
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
#: Words that announce a credential, besides those above.
CONTEXT_WORDS = "passphrase password passwd passcode pwd pass secret token apikey api_key api-key auth_key authkey access_key accesskey private_key privatekey client_secret credential credentials bearer pin".split()
_HEAD = r"(?<![A-Za-z0-9])(?:" + "|".join(sorted(map(re.escape, CONTEXT_WORDS), key=len, reverse=True)) + r""")(?![A-Za-z0-9])["']?(?:\x20*(?::=|=>|->|[:=])\x20*|\x20+is\x20+)["']?"""
_VALUE = r"""[^\s"'<>,;]*"""
HEAD, VALUE = re.compile(_HEAD, re.IGNORECASE | re.ASCII), re.compile(_VALUE, re.ASCII)
LEAST_VALUE = 6
#: The rows of a keyboard and how far each is moved to the right.
KEYBOARD = (("`1234567890-=", 0.0), ("qwertyuiop[]", 1.5), ("asdfghjkl;'", 1.75), ("zxcvbnm,./", 2.25))
#: Common passwords and words of them, by rank; the corpus's words follow.
COMMON = (
    "password admin welcome login letmein monkey dragon master hello freedom whatever shadow sunshine princess football baseball "
    "secret test guest root user system server access public private example sample changeme default temp demo love summer winter "
    "spring autumn orange purple silver golden flower pepper cookie ginger cheese coffee banana apple hunter tiger eagle falcon "
    "phoenix matrix killer ninja soccer hockey batman superman starwars computer internet google mustang ferrari thunder charlie "
    "jordan michael daniel andrew joshua thomas robert jessica ashley nicole amanda the and that have with this from your pass word"
).split()
#: After "is", what looks like a word of prose needs a threshold so many times as high.
WORDLIKE, PROSE = re.compile(r"[^\W\d_]?(?:[^\W\d_A-Z]*|[A-Z]*)"), 2.0
LONGEST = 40
RANKED = 20_000
#: log10 of the guesses for each span to be found as such, and of one brute-force character.
PER_SPAN, PER_CHAR = 1.0, 1.0
LEET = str.maketrans("@4310$57!", "aaeiossti")


def _neighbours() -> dict[str, tuple[int, int]]:
    """The direction (rows down, left or right) of each pair of keys that touch."""
    keys = [(c, row, x + left) for row, (line, left) in enumerate(KEYBOARD) for x, c in enumerate(line)]
    out = {}
    for a, row, x in keys:
        for b, row_, x_ in keys:
            if a != b and ((row == row_ and abs(x - x_) == 1) or (abs(row - row_) == 1 and abs(x - x_) < 1)):
                out[a + b] = (row_ - row, 1 if x_ > x else -1)
    return out


class GuessCost:
    """log10 of the guesses for a string, by dynamic programming over its segmentations."""

    def __init__(self, words: tuple[str, ...] | list[str] = tuple(COMMON)):
        self.rank = {}
        for i, w in enumerate(words, 1):
            self.rank.setdefault(w, i)
        self.longest = min(LONGEST, max(map(len, self.rank), default=0))
        self.touching = _neighbours()
        self.keys, self.turn = sum(len(line) for line, _ in KEYBOARD), math.log10(len(self.touching) / sum(len(line) for line, _ in KEYBOARD))

    def _walks(self, low: str) -> Iterator[tuple[int, int, float]]:
        """Keys that touch, each turn a choice among a key's neighbours; and runs of the alphabet or of digits."""
        n = len(low)
        for i in range(n - 2):
            way, turns = None, 0
            for j in range(i + 1, min(n, i + LONGEST)):
                step = self.touching.get(low[j - 1 : j + 1])
                if step is None:
                    break
                turns, way = turns + (step != way), step
                if j - i >= 2:
                    yield i, j + 1, math.log10(self.keys * (j - i)) + turns * self.turn
            step = ord(low[i + 1]) - ord(low[i])
            if abs(step) == 1 and low[i].isalnum():
                j = i + 1
                while j + 1 < min(n, i + LONGEST) and low[j].isalnum() and ord(low[j + 1]) - ord(low[j]) == step:
                    j += 1
                for end in range(i + 3, j + 2):
                    yield i, end, math.log10(36 * 2 * (end - i))

    def _repeats(self, value: str) -> Iterator[tuple[int, int, float]]:
        """A unit of up to eight characters, and how often it comes."""
        n = len(value)
        for p in range(1, 9):
            run = 0
            for i in range(n - p - 1, -1, -1):
                run = run + 1 if value[i] == value[i + p] else 0
                times = 1 + run // p
                if times > 1 and p * times >= 3:
                    yield i, i + p * times, p * PER_CHAR * 0.9 + math.log10(times + 1)

    def _spans(self, value: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, cost) of every span that is not brute force."""
        low = value.lower()
        plain, n = low.translate(LEET), len(value)
        if len(low) != n:  # a few letters get longer in lower case
            low = plain = value
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                rank = self.rank.get(low[i:j])
                cost = math.log10(rank) if rank else None
                if cost is None and (rank := self.rank.get(plain[i:j])):
                    cost = math.log10(rank) + 0.6
                if cost is not None:
                    yield i, j, cost + (0.0 if value[i:j] == low[i:j] else 0.3 if value[i + 1 : j] == low[i + 1 : j] else 1.0)
        yield from self._walks(low)
        yield from self._repeats(value)
        for pattern, cost in ((r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])", 4.6), (r"(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:(?:19|20)\d\d|\d\d)", 4.6), (r"(?:19|20)\d\d", 2.1)):
            for m in re.finditer(f"(?={'(' + pattern + ')'})", value, re.ASCII):
                yield m.start(1), m.end(1), cost

    def suffixes(self, value: str) -> list[float]:
        """The cost of the rest of ``value`` from each position."""
        starts: dict[int, list[tuple[int, float]]] = {}
        for i, j, cost in self._spans(value):
            starts.setdefault(i, []).append((j, cost + PER_SPAN))
        n = len(value)
        rest, brute = [0.0] * (n + 1), float("inf")  # the cheapest from here; and with a brute-force span open here
        for i in range(n - 1, -1, -1):
            brute = min(brute, rest[i + 1]) + PER_CHAR
            rest[i] = min([brute + PER_SPAN, *(rest[j] + c for j, c in starts.get(i, ()))])
        return rest

    def __call__(self, value: str) -> float:
        return self.suffixes(value)[0]


def corpus_words(docs: DataFrame, most: int = RANKED) -> list[str]:
    """The words of three to twenty letters that most documents hold, commonest first: a ranked list of bounded length. Values
    in a credential context are left out. Counts are of all texts, summed where they are before they are shuffled."""
    plain = F.regexp_replace("text", f"(?i){_HEAD}{_VALUE}", " ")
    words = F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(r"""(?<![^\s("'])\p{Ll}{3,20}(?![^\s.,;:!?)"'])"""), F.lit(0)))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()]


def base_matches(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the value) of the fixed patterns' matches, by start, then kind as listed."""
    found = [(m.start(), m.end(), "assign", *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), m.end(), "access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def context_values(text: str, cost: GuessCost, accepted) -> Iterator[tuple[int, int, float]]:
    """(start, end, log10 guesses) of every value in a credential context. After one that ``accepted`` takes the search goes on
    at its end, else at its start; values that end together are costed at once, so time is linear."""
    at, top, end, costs = 0, 0, -1, [0.0]
    while m := HEAD.search(text, at):
        at = start = m.end()
        if start >= end:
            top, end = start, VALUE.match(text, start).end()
            last = end
            while last > start and text[last - 1] in ".)]}:!?":
                last -= 1
            costs = cost.suffixes(text[start:last]) if last - start >= LEAST_VALUE else [0.0]
        if last - start >= LEAST_VALUE:
            prose = m.group().casefold().rstrip("\"' ").endswith(" is") and WORDLIKE.fullmatch(text, start, last)
            guesses = costs[start - top]
            yield start, last, guesses
            if accepted(start, last, guesses / (PROSE if prose else 1)):
                at = last


class Covered:
    """Whether a range touches one of these spans."""

    def __init__(self, spans: list[tuple]):
        self.starts = [s[0] for s in spans]  # in order
        self.reach = list(accumulate((s[1] for s in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        before = bisect_right(self.starts, end - 1)
        return before > 0 and self.reach[before - 1] > start


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def scan_text(text: str, cost: GuessCost, threshold: float) -> dict:
    """base and all spans, and values: {(start, end): log10 guesses} of all that stands in a credential context."""
    base, extra = base_matches(text), []
    covered = Covered(base)
    values = {(s[3], s[4]): None for s in base if s[2] == "assign"}

    def accepted(start, end, guesses):
        fits = guesses >= threshold and not covered(start, end)
        if fits:
            extra.append((start, end, "guess"))
        return fits

    values |= {(start, end): guesses for start, end, guesses in context_values(text, cost, accepted)}
    values = {k: cost(text[k[0] : k[1]]) if v is None else v for k, v in values.items()}
    base = [s[:3] for s in base]
    return {"base": base, "all": sorted([*base, *extra], key=lambda s: (s[0], KINDS.index(s[2]))), "values": dict(sorted(values.items()))}


RESULT = pa.schema([
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_guess", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()),
    ("n_values", pa.int64()), ("max_log10_guesses", pa.float64()), ("guesses", pa.string()),
])


def scan(docs: DataFrame, *, threshold: float = 8.0, words: list[str] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans, n_values, max_log10_guesses, guesses) of every text;
    guesses has start:end:power of ten of every value in a credential context. ``words`` is a ranked list to use in place of
    the corpus's own. The scan itself shuffles nothing."""
    rows = docs.select("doc_id", "text")
    ranked = [*COMMON, *(corpus_words(rows) if words is None else words)]
    shared = rows.sparkSession.sparkContext.broadcast(ranked)  # ``RANKED`` words, or the caller's list
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, n_values long, max_log10_guesses double, guesses string"

    def work(batches):
        cost = GuessCost(shared.value)
        for batch in batches:
            columns: list[list] = [[] for _ in RESULT]
            for value in batch.column("text"):
                found = scan_text(value.as_py() or "", cost, threshold)
                counts = [sum(s[2] == kind for s in found["all"]) for kind in KINDS]
                values = found["values"]
                told = ",".join(f"{a}:{b}:{g:.2f}" for (a, b), g in values.items())
                for column, x in zip(columns, (*counts, hashlib.sha256(joined(found["base"]).encode()).hexdigest(), joined(found["all"]), len(values), max(values.values(), default=None), told), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, f.type) for x, f in zip(columns, RESULT, strict=True))], names=["doc_id", *RESULT.names])

    return rows.mapInArrow(work, schema)


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN_SQL = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
#: The base columns in DuckDB. Matches are marked by two private characters, from which their positions are read off.
BASE_SQL = f"""
with d as (select row_number() over () as r, doc_id, replace(replace(coalesce(text, ''), chr(57345), ' '), chr(57346), ' ') as t from documents),
k as (select unnest([0, 1, 2]) as k),
marked as (
  select r, k, case k when 0 then regexp_replace(t, '{_ASSIGN_SQL}', chr(57345) || '\\0' || chr(57346), 'g') when 1 then regexp_replace(t, 'AKIA[A-Z0-9]+', chr(57345) || '\\0' || chr(57346), 'g')
    else regexp_replace(t, '[0-9a-f]+', chr(57345) || '\\0' || chr(57346), 'g') end as m from d, k
), parts as (select r, k, unnest(string_split(m, chr(57345))) as p, unnest(range(len(string_split(m, chr(57345))))) as i from marked where contains(m, chr(57345))),
placed as (
  select r, k, i, split_part(p, chr(57346), 1) as hit, sum(length(replace(p, chr(57346), ''))) over (partition by r, k order by i) - length(replace(p, chr(57346), '')) as start from parts
), hits as (
  select r, k, start, start + length(hit) as stop from placed where i > 0 and case k when 0 then length(regexp_extract(hit, '{_ASSIGN_SQL}', 2)) >= 8 when 1 then length(hit) >= 16 else length(hit) >= 32 end
), told as (
  select r, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
    string_agg(['assign', 'access', 'hex'][k + 1] || ':' || start::bigint || ':' || stop::bigint, ',' order by start, k) as spans from hits group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256 from d left join told using (r)
"""
