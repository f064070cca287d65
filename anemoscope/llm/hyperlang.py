"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram is the product of its
letters' vectors, each rotated by its place; a text is the sum of its n-grams, a
language the sum of its training texts. A text has the language whose profile is
closest by cosine.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

UNKNOWN = "und"
DIMENSIONS = 512
GRAM = 3
#: Languages that the profiles may hold; they are collected to the driver.
MOST_LANGUAGES = 2_000
#: Code points fit in 21 bits, so a gram of three fits in one integer.
BITS = 21

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter; made once in a process."""
    if not _letters:
        table = np.zeros(sys.maxunicode + 2, bool)
        for point in range(sys.maxunicode + 1):
            if chr(point).isalpha():
                table[point] = True
        _letters.append(table)
    return _letters[0]


def grams_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of lower-cased letters and their counts; blanks part words."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letter_table()[points], points, 0)
    padded = np.concatenate(([0], points, [0])).astype(np.uint64)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    padded = padded[keep]
    if len(padded) < GRAM:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first, second, third = padded[:-2], padded[1:-1], padded[2:]
    grams = np.sort((first << np.uint64(2 * BITS)) | (second << np.uint64(BITS)) | third)
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[starts], np.diff(np.append(starts, len(grams)))


class Vectors:
    """Vectors of grams, made on demand and kept up to a bound."""

    MOST = 60_000

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.rows = np.zeros((1024, self.dimensions), np.float32)

    def letter(self, point: int) -> np.ndarray:
        seeded = np.random.default_rng(np.random.PCG64(point + 1))
        return seeded.integers(0, 2, self.dimensions, np.int8) * 2 - 1

    def _make(self, grams: list[int]) -> None:
        mask = (1 << BITS) - 1
        points = {p for g in grams for p in (g >> 2 * BITS, g >> BITS & mask, g & mask)}
        letters = {p: self.letter(p) for p in points}
        start = len(self.known)
        while start + len(grams) > len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        for at, gram in enumerate(grams, start):
            bound = np.roll(letters[gram >> 2 * BITS], 2)
            bound = bound * np.roll(letters[gram >> BITS & mask], 1)
            self.rows[at] = bound * letters[gram & mask]
            self.known[gram] = at

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the grams' vectors, each times its count."""
        total = np.zeros(self.dimensions, np.float64)
        for start in range(0, len(grams), self.MOST // 2):
            part = grams[start : start + self.MOST // 2].tolist()
            found = list(map(self.known.get, part))
            if None in found:
                new = [g for g, f in zip(part, found, strict=True) if f is None]
                if len(self.known) + len(new) > self.MOST:
                    self._forget()
                    new = part
                self._make(new)
                found = list(map(self.known.get, part))
            weights = counts[start : start + self.MOST // 2].astype(np.float32)
            total += weights @ self.rows[found]
        return total


@dataclass(frozen=True)
class Profiles:
    """The learned languages in order, and one vector each of length 1."""

    languages: tuple[str, ...]
    vectors: np.ndarray


SUMS = pa.schema([("lang", pa.string()), ("place", pa.int32()), ("total", pa.int64())])


def learn(docs: DataFrame, training: Column, dimensions: int = DIMENSIONS) -> Profiles:
    """Profiles of the languages of the rows where ``training`` holds.

    ``docs`` needs ``text`` and ``lang``. Rows without a language, or whose text has no
    letter, teach nothing. Sums are whole numbers, so no order of rows changes them.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        vectors = Vectors(dimensions)
        totals: dict[str, np.ndarray] = {}
        for texts, languages in common.rows_of(batches, "text", "lang"):
            grams: dict[str, list] = {}
            for text, language in zip(texts, languages, strict=True):
                grams.setdefault(language, []).append(grams_of(text))
            for language, found in grams.items():
                keys, where = np.unique(
                    np.concatenate([g for g, _ in found]), return_inverse=True
                )
                counts = np.bincount(
                    where, weights=np.concatenate([c for _, c in found]), minlength=len(keys)
                )
                if len(keys):
                    total = totals.setdefault(language, np.zeros(dimensions, np.int64))
                    total += np.rint(exact_bundle(vectors, keys, counts)).astype(np.int64)
        for language, total in totals.items():
            yield common.batch(SUMS, [language] * dimensions, range(dimensions), total)

    rows = docs.where(training & F.col("lang").isNotNull()).select("text", "lang")
    sums = rows.mapInArrow(run, "lang string, place int, total bigint")
    sums = sums.groupBy("lang", "place").agg(F.sum("total").alias("total"))
    limit = MOST_LANGUAGES * dimensions
    found = sums.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = tuple(sorted({r.lang for r in found}))
    vectors = np.zeros((len(languages), dimensions))
    index = {language: n for n, language in enumerate(languages)}
    for r in found:
        vectors[index[r.lang], r.place] = r.total
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(languages, vectors / np.where(norms, norms, 1))


def exact_bundle(vectors: Vectors, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A bundle whose sums stay exact: counts in parts below 2**12 a gram."""
    total = np.zeros(vectors.dimensions, np.float64)
    counts = counts.astype(np.int64)
    for start in range(0, len(grams), 2_048):
        part, left = grams[start : start + 2_048], counts[start : start + 2_048]
        scale = 1
        while left.any():
            total += scale * vectors.bundle(part, left & 0xFFF)
            left, scale = left >> 12, scale << 12
    return total


def predict(
    docs: DataFrame, profiles: Profiles, added: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """Adds the language and the score, under the names ``added``, to the rows of ``docs``.

    The score is the cosine, from 0 to 1. A null text, a text without letters and any
    text when no language was learned give ``und`` with score 0; equal cosines give
    the first language by name. ``docs`` needs ``text``; its columns of the added names
    are replaced. Repeated rows give repeated results, an empty table none.
    """
    docs = docs.drop(*added)
    names = docs.columns
    schema = docs.select(
        *(F.col(f"`{n}`") for n in names),
        F.lit("").alias(added[0]), F.lit(0.0).alias(added[1]),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]):
        vectors = Vectors(profiles.vectors.shape[1])
        for whole in batches:
            texts = whole.column(whole.schema.get_field_index("text"))
            found, scores = [], []
            for start in range(0, len(texts), 1_000):
                for text in texts.slice(start, 1_000).to_pylist():
                    grams, counts = grams_of(text)
                    own = vectors.bundle(grams, counts) if len(grams) else None
                    if own is None or not profiles.languages or not own.any():
                        found.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    cosines = profiles.vectors @ own / np.linalg.norm(own)
                    best = int(cosines.argmax())
                    found.append(profiles.languages[best])
                    scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [*whole.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, *added],
            )

    return docs.mapInArrow(run, schema)


#: One in five documents is held out.
FOLDS = 5


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from four of five folds."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = common.fold_of(F.col("doc_id"), FOLDS)
    profiles = learn(docs, fold != 0)
    rows = docs.select("doc_id", "text", (fold == 0).alias("held_out"))
    return predict(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")
