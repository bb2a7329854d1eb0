"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters of the lower-cased text, with every run of other characters as one space, are
hashed into ``DIMENSIONS`` features. Document frequencies count every training text. The classifier is fitted on a
bounded sample - at most ``sample`` labelled documents, dealt evenly over the languages by a hash of doc_id, one language
each if there are more languages than that - by
follow-the-regularised-leader with elastic-net penalties, one document at a time; a sixth of the sample, left out of
the fit, sets the temperature of the scores. Whole texts are used throughout.

Training rows are those with a text, a language and crc32(doc_id) mod 5 other than 0. Language, source and doc_id are
never inputs of a prediction.

Defined cases: a null doc_id counts as an empty one (held out); texts that are null or have no letter are ``und`` with
score 0, as is every text if there is nothing to learn from; with one language every text with a letter gets it, score
1; ties go to the language first in code-point order. Repeated rows get equal results and are learnt from once; very long
texts are worked through in pieces of about ``PIECE`` characters, with the same counts as in one. Other columns, of any name,
come through ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import own, packed, small, unpacked, written

DIMENSIONS = 1 << 16
PIECE = 1 << 20
UNKNOWN = "und"
_LETTERS = np.array([chr(i).isalpha() for i in range(1 << 16)])


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, anything else as 0."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTERS[np.minimum(c, 0xFFFF)]
    far = np.flatnonzero(c > 0xFFFF)
    if len(far):
        letter[far] = [chr(x).isalpha() for x in c[far]]
    return np.where(letter, c, np.uint32(0))


def _grams(c: np.ndarray, new: int) -> np.ndarray:
    """Feature numbers of the n-grams, one to three characters, that end in the last ``new`` codes and hold a letter."""
    a = c * np.uint32(2654435761)
    b = c * np.uint32(2246822519) + np.uint32(374761393)
    d = c * np.uint32(3266489917) + np.uint32(668265263)
    two = a[:-1] ^ b[1:]
    three = (two[:-1] * np.uint32(2654435769)) ^ d[2:]
    found = np.concatenate([a[-new:][c[-new:] > 0], two[-new:], three[-new:]])
    found ^= found >> np.uint32(15)
    found *= np.uint32(2246822507)
    return (found >> np.uint32(16)).astype(np.int64)


def _pieces(text: str) -> Iterator[str]:
    """Pieces that end behind something that isn't a letter, where there is one, so that lower-casing sees whole words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        cut = end
        while end < len(text) and cut > at and text[cut - 1].isalpha():
            cut -= 1
        end = cut if cut > at else end
        yield text[at:end]
        at = end


def gram_counts(text: str | None) -> np.ndarray | None:
    """Occurrences of every feature; None without a letter. Runs of what isn't a letter count as one space, at both ends, too."""
    if not text:
        return None
    total, tail = np.zeros(DIMENSIONS, np.int64), np.zeros(1, np.uint32)
    for piece in (*_pieces(text), " "):
        c = np.concatenate([tail, _codes(piece)])
        keep = c > 0
        keep[1:] |= c[:-1] > 0
        fresh = c[len(tail) :][keep[len(tail) :]]
        if len(fresh):
            c = np.concatenate([tail, fresh])
            total += np.bincount(_grams(c, len(fresh)), minlength=DIMENSIONS)
            tail = c[-2:]
    return total if len(tail) > 1 else None


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def vector(index: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights with damped counts, of length one."""
    x = np.log1p(count) * idf[index]
    return x / max(1e-12, float(np.sqrt(x @ x)))


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """Over all training texts: the documents that hold each feature, counted where the texts are."""
    schema = pa.schema([("feature", pa.int32()), ("n", pa.int64())])

    def count(batches):
        df, docs = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for value in batch.column("text"):
                counts = gram_counts(value.as_py())
                if counts is not None:
                    df += counts > 0
                    docs += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], docs))], schema=schema)

    parts = training.select("text").mapInArrow(count, "feature int, n long")
    rows = parts.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # at most DIMENSIONS + 1 rows
    df, n = np.zeros(DIMENSIONS, np.int64), 0
    for feature, count_ in zip(rows.column("feature").to_pylist(), rows.column("n").to_pylist(), strict=True):
        if feature < 0:
            n = count_
        else:
            df[feature] = count_
    return df, n


def sample_features(training: DataFrame, sample: int, seed: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, features, counts) of at most ``sample`` training documents, about as many of each language."""
    keys = training.select("doc_id", "lang", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("h"))
    counts = written(keys.groupBy("lang").agg(F.count("*").alias("docs")), "langid-languages")
    languages = counts.count()
    each = max(1, sample // max(1, languages))
    # twice as many as needed pass a threshold on the hash, so what is ranked follows the sample, not the corpus
    share = F.shiftrightunsigned("h", 11) / float(1 << 53)
    keys = keys.join(small(counts, languages), "lang").where(share * F.col("docs") <= 2.0 * each + 20)
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = keys.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= each)
    picked = written(picked.groupBy("h", F.col("doc_id").alias("own_id")).agg(F.lit(1).alias("one")).orderBy("h", "own_id").limit(sample), "langid-sample")
    rows = training.join(small(picked, sample), F.col("doc_id") == F.col("own_id"), "left_semi")
    # rows that share an id: equal ones once, and of others no more than the sample has room for
    rows = rows.select("doc_id", "lang", "text", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("h"), F.xxhash64("text").alias("version"))
    schema = pa.schema([("lang", pa.string()), ("doc_id", pa.string()), ("h", pa.int64()), ("version", pa.int64()), ("features", pa.binary()), ("counts", pa.binary())])

    def extract(batches):
        for batch in batches:
            out = []
            for lang, doc_id, h, version, value in zip(*(batch.column(c).to_pylist() for c in ("lang", "doc_id", "h", "version")), batch.column("text"), strict=True):
                counts = gram_counts(value.as_py())
                if counts is not None:
                    at = np.flatnonzero(counts)
                    out.append((lang, str(doc_id), h, version, at.astype(np.int32).tobytes(), np.minimum(counts[at], 2**31 - 1).astype(np.int32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    found = rows.mapInArrow(extract, "lang string, doc_id string, h long, version long, features binary, counts binary")
    place = ["h", "doc_id", "lang", "version"]
    found = found.groupBy(*place).agg(F.first("features").alias("features"), F.first("counts").alias("counts")).orderBy(*place).limit(sample)
    found = written(found, "langid-features").toArrow()
    order = sorted(range(found.num_rows), key=lambda i: (found["doc_id"][i].as_py(), found["lang"][i].as_py(), found["version"][i].as_py()))
    # views of the table's own buffers
    part = lambda name, i: np.frombuffer(found[name][i].as_buffer(), np.int32)
    return [(found["lang"][i].as_py(), part("features", i), part("counts", i)) for i in order]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def parts(self) -> tuple:
        """What workers need, as plain arrays and names: no class that only the driver may know travels."""
        return self.languages, self.idf, self.weights, self.bias, self.temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        return predict_text(text, *self.parts())


def predict_text(text: str | None, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float) -> tuple[str, float]:
    counts = gram_counts(text)
    if counts is None or not languages:
        return UNKNOWN, 0.0
    at = np.flatnonzero(counts)
    z = (vector(at, counts[at], idf) @ weights[at] + bias) / temperature
    p = np.exp(z - z.max())
    best = int(np.argmax(p))
    return languages[best], float(p[best] / p.sum())


class Ftrl:
    """Per-coordinate follow-the-regularised-leader: weights follow from z and n, exact zeros from the L1 part."""

    def __init__(self, features: int, classes: int, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))

    def weights(self, rows) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def step(self, rows: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        u = x @ w
        p = np.exp(u - u.max())
        p /= p.sum()
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[rows]
        self.z[rows] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[rows] = n + g * g


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3, seed: int = 11) -> Model:
    """The classifier of a bounded sample, then the temperature that fits its left-out sixth best."""
    languages = sorted({lang for lang, _, _ in rows}, key=lambda s: s.encode())
    if not languages:
        return Model([], idf, np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0))
    number = {lang: i for i, lang in enumerate(languages)}
    data = [(np.append(f, DIMENSIONS).astype(np.int32), np.append(vector(f, c, idf), 1.0).astype(np.float32), number[lang]) for lang, f, c in rows]
    kept = [d for i, d in enumerate(data) if i % 6 or len(data) < 12]
    aside = [d for i, d in enumerate(data) if i % 6 == 0] or data
    learner, rng = Ftrl(DIMENSIONS + 1, len(languages)), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(kept)):
            learner.step(*kept[i])
    weights = learner.weights(slice(None))
    z = np.stack([x @ weights[rows_] for rows_, x, _ in aside])
    y = np.array([label for _, _, label in aside])

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        own, others = s[np.arange(len(y)), y], s.sum(1)
        spread = (others - own) / max(1, len(languages) - 1)
        doubt = 1 / (len(y) + 2)  # a sample without an error doesn't make for certainty
        return float((np.log(np.exp(s).sum(1)) - (1 - doubt) * own - doubt * spread).mean())

    temperature = min((0.05 * 1.15**k for k in range(43)), key=loss)
    return Model(languages, idf, weights[:-1].astype(np.float32), weights[-1], temperature)


def train(docs: DataFrame, *, sample: int = 3000, seed: int = 11) -> Model:
    """A model of the training rows of ``docs`` (doc_id, text, lang)."""
    training = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    df, n = document_frequencies(training)
    idf = np.log((1 + n) / (1 + df)) + 1
    model = fit(sample_features(training, sample, seed), idf, seed=seed)
    pa.default_memory_pool().release_unused()  # the driver goes on without the sample
    return model


def predict(docs: DataFrame, model: Model, *, within: str | None = None) -> DataFrame:
    """``docs`` with lang_pred and score (replaced if they exist), from the text alone; it is a column, or a field of the struct
    ``within``, so that packed rows travel to the workers and back without a second copy of their texts."""
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*[own(c) for c in columns])
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(within).field("text") if within else batch.column("text")
            found = [predict_text(value.as_py(), *known) for value in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(work, schema)


def identify(docs: DataFrame, *, sample: int = 3000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, by a model trained on the others."""
    found = predict(docs.select("doc_id", "text"), train(docs, sample=sample))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, *, least: float = 0.3, sample: int = 3000) -> DataFrame:
    """``docs``, in its own columns, less those whose language is unknown or scored below ``least``."""
    found = predict(packed(docs), train(docs, sample=sample), within="row")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*unpacked(docs.columns))
