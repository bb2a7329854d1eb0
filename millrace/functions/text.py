"""Column expressions for text: cleaning, densities, tokens, signatures, extraction. All native but for
``top_gram_share``, all null-safe: a null text is an empty one, as everywhere in curation."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import arrow

# Patterns whose matches define results. Word boundaries are ASCII ones where the rule was written for
# an ASCII dialect; (?U) marks Unicode classes.
CONTROLS = r"[\x00-\x08\x0B-\x1F\x7F\u200B\u200C\u00AD\uFFFD]"
HYPHENATED = r"(?U)\b([A-Za-z]{2,})-\s*\n\s*([A-Za-z]{2,})\b"
EDGE_L, EDGE_R = r"(?<![0-9A-Za-z_])", r"(?![0-9A-Za-z_])"
BOILERPLATE = "|".join(
    [
        rf"(?is:<(?:script|style){EDGE_R}[^>]*>.*?</(?:script|style)>)",
        r"<[^>]+>",
        rf"(?i:{EDGE_L}page[\t\n\f\r ]+[0-9]+[\t\n\f\r ]+of[\t\n\f\r ]+[0-9]+{EDGE_R})",
        r"(?i:copyright[\t\n\f\r ]+(?:\(c\)|©)?[\t\n\f\r ]*[0-9]{4}[^.\n]*\.)",
        rf"(?i:{EDGE_L}(?:confidential - internal use only|confidential|draft copy){EDGE_R})",
    ]
)
BLANK_LINES = r"\n[ \t\n]*\n"
TRIM = r"(?U)\A\s+|\s+\z"
PUNCTUATION = [".", ",", "?", "!", ";", ":"]
SYMBOLS = ["#", "$", "%", "@", "^", "*"]
STOP_WORDS = ["the", "and", "is", "of", "to", "a", "in", "that"]
CODE_SYMBOLS = ["{", "}", ";", "[", "]", "=", "->", "<", ">"]
CODE_MARKS = ["{", "}", ";"]
DANGLING = ["+", "-", "=", "&&", "||", "==", "!=", "<", ">", "*", "/", ":", ","]
FENCE = r"(?s)(?:```|<pre><code>)(.*?)(?:```|</code></pre>)"
#: Tokens of code in any language: white space, comments, closed strings, numbers, names, operators.
TOKENS = r"""[\t\n\f\r ]+|(?:#|//)[^\n]*|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[0-9][0-9A-Za-z_.]*|[A-Za-z_][0-9A-Za-z_]*|[-+*/%=<>!&|^~?:;,.(){}\[\]@]"""
#: Characters with which a token can always begin (a quote may have no end), one by one: the engine looks these up in a table of bits,
#: while a class of ranges took ten times as long.
STARTS = r"\t\n\f\r " + "".join(f"\\x{k:02X}" for k in range(33, 127) if chr(k) not in "\"'$\\`")
#: Entity patterns of the redactor, in the order in which they are replaced.
ENTITIES = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "CREDIT_CARD": r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b",
    "US_SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "IP_ADDRESS": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "PHONE_NUMBER": r"(?:\+1 )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}",
}


def text(c: Column | str) -> Column:
    """Null becomes empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip_controls(c: Column) -> Column:
    """Control and phantom characters go; tab and line feed stay."""
    return F.regexp_replace(c, CONTROLS, "")


def dehyphenate(c: Column) -> Column:
    """Words split over a line end are joined."""
    return F.regexp_replace(c, HYPHENATED, "$1$2")


def trim_all(c: Column) -> Column:
    """White space of any script goes at both ends."""
    return F.regexp_replace(c, TRIM, "")


def strip_boilerplate(c: Column) -> Column:
    """Markup, page stamps, copyright lines and confidentiality marks go, blank lines collapse, ends are trimmed."""
    return trim_all(F.regexp_replace(F.regexp_replace(c, BOILERPLATE, ""), BLANK_LINES, "\n"))


def occurrences(c: Column, what: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))) / len(what)).cast("long")


def _sum(columns: list[Column]) -> Column:
    return reduce(add, columns)


def code_density(c: Column) -> Column:
    """Braces and semicolons per character, in single precision."""
    return (_sum([occurrences(c, x) for x in CODE_MARKS]) / F.greatest(F.length(c), F.lit(1))).cast("float")


def is_code_heavy(c: Column, *, at_limit: bool = True) -> Column:
    """Over 5 %. The single-precision 5 % is above the double one, so a text of exactly 5 % is flagged; not so ``at_limit`` false,
    which compares in single precision, as SQL does."""
    return code_density(c).cast("double") > 0.05 if at_limit else code_density(c) > F.lit(0.05).cast("float")


def symbol_density(c: Column) -> Column:
    """Programming symbols per character that isn't white space; an arrow counts as itself and as its point."""
    solid = F.length(F.regexp_replace(c, r"[\t\n\f\r ]+", ""))
    return _sum([occurrences(c, x) for x in CODE_SYMBOLS]).cast("double") / F.when(solid == 0, 1).otherwise(solid)


def ascii_lower(c: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(c, upper, upper.lower())


def words_by_spaces(c: Column) -> Column:
    """Spaces and one more."""
    return occurrences(c, " ") + 1


def punctuation_ratio(c: Column) -> Column:
    return _sum([occurrences(c, x) for x in PUNCTUATION]).cast("double") / words_by_spaces(c)


def symbol_ratio(c: Column) -> Column:
    return _sum([occurrences(c, x) for x in SYMBOLS]).cast("double") / words_by_spaces(c)


def stop_word_ratio(c: Column) -> Column:
    low = ascii_lower(c)
    return _sum([occurrences(low, f" {x} ") for x in STOP_WORDS]).cast("double") / words_by_spaces(c)


def tokens(c: Column) -> Column:
    """Lower-cased, split at white space of any script, no empties."""
    return F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda x: x != "")


def alnum_tokens(c: Column) -> Column:
    """Lower-cased, other characters than word ones as spaces, split."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", " "), r"(?U)\s+"), lambda x: x != "")


def bind(value: Column, fn) -> Column:
    """fn(value), with ``value`` computed once a row."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words joined by one space; none with fewer words."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return bind(words, lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(F.array().cast("array<string>")))


def gram_hashes(words: Column, n: int) -> Column:
    """64-bit hashes of runs of n words; none with fewer words. Eight bytes a run to explode, sort or join by."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))
    return bind(words, lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(F.array().cast("array<bigint>")))


def top_gram_share(c: Column, n: int = 3, least: int = 15) -> Column:
    """The commonest n-gram's share of all n-grams; 0 with fewer than ``least`` words. Counted by the Arrow workers: the engine's
    own lambdas, which aren't compiled, take over ten times as long."""
    return arrow.gram_share(F.lower(c), n, least)


def content_signature(c: Column) -> Column:
    """The first eight bytes of MD5, little-endian, signed."""
    turned = lambda md5: F.concat(*[F.substring(md5, 2 * k + 1, 2) for k in range(7, -1, -1)])
    return F.conv(bind(F.md5(c.cast("binary")), turned), 16, -10).cast("long")  # one MD5 of a text, wherever a filter goes


def gram_hash(c: Column, digits: int = 16) -> Column:
    """SHA-256 in hex, or its first digits."""
    return F.substring(F.sha2(c, 256), 1, digits)


def lexer_error_ratio(c: Column) -> Column:
    """Characters that start no token, among tokens; 0 without any. Where a token begins it is taken whole, so counting all
    tokens, with and without a last resort of any character, tells the errors."""
    odd = c.rlike(f"[^{STARTS}]")  # without such, each character starts a token
    every = F.regexp_count(c, F.lit(f"(?s){TOKENS}|."))
    share = lambda n: F.when(n["every"] > 0, (n["every"] - n["known"]) / n["every"]).otherwise(F.lit(0.0))
    return F.when(odd, bind(F.struct(every.alias("every"), F.regexp_count(c, F.lit(TOKENS)).alias("known")), share)).otherwise(F.lit(0.0))


def for_model(c: Column, limit: int, one_line: bool = True) -> Column:
    """What a scorer reads: line feeds as spaces, at most ``limit`` characters."""
    return F.substring(F.replace(c, F.lit("\n"), F.lit(" ")) if one_line else c, 1, limit)


def paragraphs(c: Column) -> Column:
    """Split at blank lines, trimmed, no empties."""
    return F.filter(F.transform(F.split(c, r"(?U)\n\s*\n"), trim_all), lambda x: x != "")


def strip_comments(c: Column) -> Column:
    """Triple-quoted strings and # comments go, blank lines collapse. A # within a string counts as a comment too."""
    out = F.regexp_replace(c, r"(?s)\"\"\".*?\"\"\"", "")
    out = F.regexp_replace(out, r"(?s)'''.*?'''", "")
    out = F.regexp_replace(out, r"#[^\n]*", "")
    return trim_all(F.regexp_replace(out, r"(?U)\n\s*\n", "\n"))


def solid_lines(c: Column) -> Column:
    """Lines, trimmed, no empties."""
    return F.filter(F.transform(F.split(c, "\n"), trim_all), lambda x: x != "")


def code_snippets(c: Column) -> Column:
    """What stands between code fences; the whole text if there is none."""
    return bind(F.regexp_extract_all(c, F.lit(FENCE), F.lit(1)), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(c)))


def longest_line(c: Column) -> Column:
    return F.array_max(F.transform(F.split(c, "\n"), F.length))


def dangling_end(c: Column) -> Column:
    """Whether the text, trimmed at its end, stops on an operator."""
    end = F.regexp_replace(c, r"(?U)\s+\z", "")
    return (F.length(end) > 0) & reduce(lambda x, y: x | y, [end.endswith(F.lit(x)) for x in DANGLING])


def redact(c: Column, entities: dict[str, str] | None = None) -> Column:
    """Entities become their bracketed names."""
    return reduce(lambda out, e: F.regexp_replace(out, e[1], f"[{e[0]}]"), (entities or ENTITIES).items(), c)


def entity_count(c: Column, entity: str) -> Column:
    return F.regexp_count(c, F.lit(ENTITIES[entity]))


def utf8(c: Column) -> Column:
    return F.make_valid_utf8(c)


def _after(c: Column, mark: str) -> Column:
    """What stands between the first ``mark`` and the next fence, trimmed."""
    return trim_all(F.get(F.split(F.get(F.split(c, mark, -1), F.lit(1)), "```", -1), F.lit(0)))


def unfence(c: Column, kind: str) -> Column:
    """The body of the first fence of this kind, else of the first fence, else the whole text; trimmed."""
    return F.when(c.contains(f"```{kind}"), _after(c, f"```{kind}")).when(c.contains("```"), _after(c, "```")).otherwise(trim_all(c))


def final_number(c: Column) -> Column:
    """The number that starts what follows the last ####, else the last number; commas and dollar signs left out."""
    plain = F.regexp_replace(c, r"[,$]", "")
    tail = trim_all(F.element_at(F.split(plain, "####", -1), -1))
    marked = F.when(c.contains("####"), F.regexp_extract(tail, r"\A-?[0-9]+(?:\.[0-9]+)?", 0))
    every = F.regexp_extract_all(plain, F.lit(r"-?[0-9]+(?:\.[0-9]+)?"), F.lit(0))
    return F.coalesce(F.nullif(marked, F.lit("")), F.try_element_at(every, F.lit(-1)))


def numbers_match(a: Column, b: Column, rel: float = 1e-5) -> Column:
    """Whether two answers are close as numbers, or equal but for case where one is none. Missing ones never match."""
    x, y = a.try_cast("double"), b.try_cast("double")
    close = F.abs(x - y) <= F.greatest(F.abs(x), F.abs(y)) * rel
    same = F.lower(trim_all(a)) == F.lower(trim_all(b))
    return F.coalesce(F.when(x.isNotNull() & y.isNotNull(), close).otherwise(same), F.lit(False))


def is_json_object(c: Column) -> Column:
    """Whether the whole text is one JSON object. The parser stops after a value, so the text is read as the first of two."""
    two = F.try_parse_json(F.concat(F.lit("["), c, F.lit(",0]")))
    whole = (F.try_variant_get(two, "$[1]", "int") == 0) & F.try_variant_get(two, "$[2]", "string").isNull()
    return F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT") & whole, F.lit(False))


def json_has_keys(c: Column, keys: list[str]) -> Column:
    """Whether the text is a JSON object with all keys."""
    object_ = is_json_object(c)
    names = F.when(object_, F.json_object_keys(c))
    return F.coalesce(object_ & reduce(lambda x, y: x & y, [F.array_contains(names, k) for k in keys], F.lit(True)), F.lit(False))


def judge_winner(c: Column) -> Column:
    """Which candidate a judge's answer names: by its JSON, else by its words, else a tie."""
    body = unfence(trim_all(c), "json")
    said = trim_all(F.coalesce(F.get_json_object(body, "$.winner"), F.lit("")))
    by_json = F.when(said.contains("Candidate 1"), "Candidate 1").when(said.contains("Candidate 2"), "Candidate 2").otherwise("Tie")
    by_words = F.when(c.rlike(r"(?iU)Candidate\s*1"), "Candidate 1").when(c.rlike(r"(?iU)Candidate\s*2"), "Candidate 2").otherwise("Tie")
    return F.when(is_json_object(body), by_json).otherwise(by_words)
