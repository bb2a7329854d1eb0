"""Documents for the operators' tests: nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, node long, key string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    """(doc_id, text, lang, source) rows, with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, 7, 3, "k") for r in rows], SCHEMA)


def odd_rows(rng):
    """Null, empty, blank, one word, very long, repeated and tied rows."""
    long = sentence(rng, 40_000)
    return [
        (None, None, None, None), (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (4, "word", "de", "b"), (5, long, "en", "a"),
        (6, "same text here twice over again", "en", "a"), (6, "same text here twice over again", "en", "a"), (6, "another text under one id now", "en", "b"), (None, "no id but text of some words", "fr", "b"),
    ]


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n=5):
    words = WORDS.findall(lower_ascii(text or ""))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def rng(seed=1):
    return random.Random(seed)
