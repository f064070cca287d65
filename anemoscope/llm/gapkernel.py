"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

Two strings are alike as far as they share letters in the same order, each gap costing
a factor, so an insult with inserted or missing letters stays close to the insult. The
kernel is approximated by Nystroem features: its values against landmark strings mined
from labelled texts, whitened by the landmarks' own kernel matrix. A text has the largest
value that any of its words has with each landmark, and how many of its words are close to
one; a linear SVM on these signs scores it.
"""

import math
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

#: Letters of a common subsequence, the most that may stand between two of them, and the
#: factor that each letter it spans costs.
LENGTH, GAP, DECAY = 3, 2, 0.7
#: How fast the exponential of the kernel falls off; letters are known by their code modulo this.
SHARP, LETTER_IDS = 4.0, 65_521
#: Labelled documents that the machine is trained on, at most.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1_200, 2_000
#: Landmarks expected by chance alone, the share of a landmark's texts that may be clean (at
#: equal numbers of both), the kernel value from which a word is like a landmark, and the
#: ridge of the machine.
CHANCE, PURE, NEAR, RIDGE = 0.01, 0.03, 0.4, 0.05
#: Longer words are cut into overlapping windows of this many letters.
WINDOW = 10
START = "^"
#: Odd factors that turn one hash into several.
TURNS = np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B1) | np.uint64(1)


def letters_of(word: bytes) -> str:
    """The lower-case letters of a word, without what is written between them."""
    text = word.decode().lower()
    return text if text.isalpha() else "".join(filter(str.isalpha, text))


def spaced_out(words: list[bytes]) -> list[bytes]:
    """Words that were written as three or more single letters with blanks between."""
    found, run = [], []
    for word in [*words, b"  "]:
        if len(word) == 1:
            run.append(word)
        else:
            if len(run) >= 3:
                found.append(b"".join(run))
            run = []
    return found


def distinct_words(text: str | None) -> set[bytes]:
    words = common.words_of(text.lower()) if text else []
    found = set(words)
    if list(map(len, words)).count(1) >= 3:
        found.update(spaced_out(words))
    return found


def windows(word: str) -> list[str]:
    marked = START + word
    if len(marked) <= WINDOW:
        return [marked]
    half = WINDOW // 2
    return [marked[i : i + WINDOW] for i in range(0, len(marked) - half, half)]


class Kernel:
    """The subsequence kernel of any strings with fixed landmarks.

    Letters of a common subsequence may stand up to ``GAP`` letters apart in each string.
    That leaves few subsequences to a string, so the kernel is the product of two sparse
    vectors, each subsequence weighted by ``DECAY`` to the number of letters that its
    tightest occurrence spans. It is scaled so that each string is like itself by 1, and
    ``exp(SHARP * (value - 1))``, a kernel again, tells an insult from words that only share
    its beginning.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        letters = sorted({c for s in landmarks for c in s})
        self.size = len(letters) + 1
        self.table = np.zeros(sys.maxunicode + 2, np.int32)
        self.table[[ord(c) for c in letters]] = np.arange(1, self.size)
        keys: dict[int, dict[int, float]] = {}
        for value, places in self._keys(landmarks):
            for n, key in zip(np.nonzero(places)[0].tolist(), places[places != 0].tolist()):
                at = keys.setdefault(key, {})
                at[n] = max(at.get(n, 0.0), value)
        self.rows = np.zeros((len(keys) + 1, len(landmarks)))
        self.lookup = np.zeros(self.size**LENGTH, np.int32)
        for row, (key, values) in enumerate(keys.items(), 1):
            self.lookup[key] = row
            self.rows[row, list(values)] = list(values.values())
        self.norms = self._own(landmarks)

    def _keys(self, strings: list[str]):
        """Each way to leave gaps: its weight, and the key of the subsequence at each place."""
        width = max(map(len, strings), default=0)
        ids = np.zeros((len(strings), width), np.int32)
        for n, s in enumerate(strings):
            ids[n, : len(s)] = self.table[list(map(ord, s))]
        for first in range(1, GAP + 2):
            for second in range(1, GAP + 2):
                end = width - first - second
                if end > 0:
                    a, b, c = ids[:, :end], ids[:, first : first + end], ids[:, first + second :]
                    key = (a * self.size + b) * self.size + c
                    key[(a == 0) | (b == 0) | (c == 0)] = 0
                    yield DECAY ** (first + second + 1), key

    def _products(self, strings: list[str]) -> np.ndarray:
        hits = []
        for value, keys in self._keys(strings):
            rows = self.lookup[keys]
            at, place = np.nonzero(rows)
            hits.append((at * len(self.rows) + rows[at, place], np.full(len(at), value)))
        out = np.zeros((len(strings), self.rows.shape[1]))
        pairs = np.concatenate([p for p, _ in hits]) if hits else np.zeros(0, np.int64)
        if not len(pairs):
            return out
        values = np.concatenate([v for _, v in hits])
        order = np.lexsort((-values, pairs))  # the tightest occurrence of each comes first
        pairs, values = pairs[order], values[order]
        first = np.concatenate(([True], pairs[1:] != pairs[:-1]))
        at, rows = np.divmod(pairs[first], len(self.rows))
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out[at[starts]] = np.add.reduceat(self.rows[rows] * values[first][:, None], starts)
        return out

    def _own(self, strings: list[str]) -> np.ndarray:
        """Each string's product with itself, over the tightest occurrence of its subsequences."""
        width = max(map(len, strings), default=0)
        ids = np.zeros((len(strings), width), np.int64)
        for n, s in enumerate(strings):
            ids[n, : len(s)] = list(map(ord, s))
        ids %= LETTER_IDS
        parts = []
        for first in range(1, GAP + 2):
            for second in range(1, GAP + 2):
                end = width - first - second
                if end > 0:
                    a, b, c = ids[:, :end], ids[:, first : first + end], ids[:, first + second :]
                    key = ((a << 16 | b) << 16 | c) << 4 | (first + second)
                    key[c == 0] = 0
                    parts.append(key)
        if not parts:
            return np.zeros(len(strings))
        keys = np.sort(np.concatenate(parts, axis=1), axis=1)
        first = np.ones(keys.shape, bool)
        first[:, 1:] = (keys[:, 1:] >> 4) != (keys[:, :-1] >> 4)
        weights = DECAY ** (2.0 * np.arange(16) + 2.0)
        return np.where(first & (keys > 0), weights[keys & 15], 0.0).sum(1)

    def likeness(self, strings: list[str]) -> np.ndarray:
        """The kernel of each string with each landmark, all scaled to length one."""
        scale = np.sqrt(np.outer(np.maximum(self._own(strings), 1e-9), self.norms))
        return np.minimum(self._products(strings) / scale, 1.0)

    def __call__(self, strings: list[str]) -> np.ndarray:
        return np.exp(SHARP * (self.likeness(strings) - 1))

    def whitening(self) -> np.ndarray:
        """The inverse square root of the landmarks' own values."""
        values, vectors = np.linalg.eigh(self(self.landmarks))
        return vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T


def by_chance(found: int, among: int, share: float) -> float:
    """The probability of ``found`` or more of ``among`` texts when each has ``share``."""
    value = total = math.exp(
        math.lgamma(among + 1) - math.lgamma(found + 1) - math.lgamma(among - found + 1)
        + found * math.log(share) + (among - found) * math.log1p(-share)
    )
    for n in range(found, among):
        value *= (among - n) / (n + 1) * share / (1 - share)
        total += value
    return min(total, 1.0)


def without_near_copies(texts: list[set[str]]) -> list[set[str]]:
    """One of each group of texts with mostly the same words; copies are no evidence of their own.

    Found by equal smallest hashes, eight a text, and compared by their words.
    """
    kept: list[set[str]] = []
    seen: dict[tuple[int, int], list[int]] = {}
    for words in texts:
        hashes = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
        turned = (hashes * f for f in TURNS) if words else ()
        keys = [(n, int((t % np.uint64(2**32)).min())) for n, t in enumerate(turned)]
        near = {m for key in keys for m in seen.get(key, ())}
        if any(2 * len(words & kept[m]) > len(words | kept[m]) - len(words & kept[m]) for m in near):
            continue
        for key in keys:
            seen.setdefault(key, []).append(len(kept))
        kept.append(words)
    return kept


def mine_landmarks(toxic: list[set[str]], clean: list[set[str]]) -> tuple[list[str], list[str]]:
    """Stems that tell toxic texts from clean ones, and the commonest clean words for contrast.

    A stem is taken if it hardly occurs in clean texts and is in more toxic ones than
    ``CHANCE`` allows over all stems tried, had labels nothing to do with words. So an insult
    is taken once it is in a handful of texts, however many there are, and words of wrongly
    labelled texts are not. Of a stem and its beginnings one is kept, the longest among
    those about as frequent. Ties go to the longer stem, then by name.
    """

    def stems(words: set[str]) -> set[str]:
        return {w[:k] for w in words for k in range(3, min(len(w), WINDOW - 1) + 1)}

    toxic = without_near_copies(toxic)
    found: Counter = Counter()
    for words in toxic:
        found.update(stems(words))
    tried = len(found)
    found = Counter({s: n for s, n in found.items() if n > 1})
    elsewhere: Counter = Counter()
    common_words: Counter = Counter()
    for words in clean:
        elsewhere.update(s for s in stems(words) if s in found)
        common_words.update(w for w in words if 2 < len(w) <= 8)
    scale = len(toxic) / max(1, len(clean))
    share = len(toxic) / max(1, len(toxic) + len(clean))
    good = {
        s: n for s, n in found.items()
        if elsewhere[s] * scale <= PURE * n
        and by_chance(n, n + elsewhere[s], share) * tried <= CHANCE
    }
    chosen: list[str] = []
    for pick in sorted(good, key=lambda s: (-good[s], -len(s), s)):
        if any(s.startswith(pick) or pick.startswith(s) for s in chosen):
            continue
        longer = [s for s in good if s.startswith(pick) and good[s] >= 0.9 * good[pick]]
        chosen.append(max(longer, key=lambda s: (len(s), good[s], s)))
    contrast = sorted(common_words, key=lambda w: (-common_words[w], w))[:8]
    contrast = [s for s in contrast if s not in chosen]
    return [START + s for s in chosen], [START + s for s in contrast]


class Words:
    """Kernel values of words with the landmarks (the largest over a word's windows), kept once."""

    def __init__(self, kernel: Kernel):
        self.kernel = kernel
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.values = np.zeros((0, len(self.kernel.landmarks)), np.float32)

    def add(self, words: set[str]) -> None:
        """Adds what is new of ``words``; strings of letters, none of them empty."""
        new = sorted(words.difference(self.at))
        if len(self.at) + len(new) > len(self.values):  # twice the room, so that few are copied
            room = np.zeros((2 * (len(self.at) + len(new)), self.values.shape[1]), np.float32)
            room[: len(self.at)] = self.values[: len(self.at)]
            self.values = room
        for start in range(0, len(new), 4_096):
            parts = [windows(w) for w in new[start : start + 4_096]]
            found = self.kernel([p for part in parts for p in part])
            starts = np.cumsum([0, *map(len, parts[:-1])])
            here = len(self.at) + start
            self.values[here : here + len(parts)] = np.maximum.reduceat(found, starts)
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))

    def __getitem__(self, words: list[str]) -> np.ndarray:
        return self.values[[self.at[w] for w in words]]


def signs_of(values: np.ndarray) -> np.ndarray:
    """A text's signs from its distinct words' values.

    The largest value with each landmark, then how many words are close to any, by number
    and by share.
    """
    if not len(values):
        return np.zeros(values.shape[1] + 2)
    found = int((values.max(1) >= NEAR).sum())
    return np.append(values.max(0), (np.log1p(found), np.log1p(100 * found / len(values))))


@dataclass
class Machine:
    """Landmarks, the SVM's weights of a text's signs, and the scale of scores."""

    kernel: Kernel | None
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def probability(self, signs: np.ndarray) -> np.ndarray:
        margins = signs @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.scale * margins + self.shift, -40, 40)))

    def score(self, texts: list[set[str]], words: Words | None) -> tuple[list[float], list]:
        """Score and worst word of texts, given by their words of letters.

        The worst word is the one with the largest part in the margin, the first of equal ones.
        """
        if self.kernel is None:
            return [0.0] * len(texts), [None] * len(texts)
        words.add(set().union(*texts))
        own = self.weights[:-2].astype(np.float32)
        signs, worst = np.zeros((len(texts), len(self.weights))), []
        for n, text in enumerate(texts):
            named = sorted(text)
            values = words[named]
            signs[n] = signs_of(values)
            worst.append(named[int(np.argmax(values @ own))] if named else None)
        return self.probability(signs).tolist(), worst


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; y is +1 or -1."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.eye(x1.shape[1]) * RIDGE
    ridge[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(50):
        active = y * (x1 @ w) < 1
        part = x1[active] * weight[active, None]
        new = np.linalg.solve(ridge + part.T @ x1[active], part.T @ y[active])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def fit_scale(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic scale and shift of margins (Platt) by halved Newton steps, softened targets."""
    positive, negative = weight[y > 0].sum(), weight[y < 0].sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.column_stack([margins, np.ones(len(margins))])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * w @ w)

    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (weight * (p - target)) + 1e-3 * w)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def with_gaps(word: str) -> list[str]:
    """The word with one letter more, or one less; what the machine must still know."""
    half = len(word) // 2
    more = [word[:n] + "xq"[n % 2] + word[n:] for n in {1, half, len(word) - 1}]
    return [*more, word[:half] + word[half + 1 :]] if len(word) > 4 else more


def train(texts: list[tuple[int, str | None]]) -> Machine:
    """The machine for labelled texts (1 is toxic); without both labels it scores 0.

    Which word makes a text toxic isn't labelled: words like a mined landmark are taken for
    it. A landmark *tells* if words like it hardly occur in clean texts. Each toxic text with
    words like a telling landmark is shown to the machine again with one of them alone, as it
    stands and with a letter more or less, so that one such word suffices; all forms of a
    text weigh as one. Toxic texts without any word like a landmark teach nothing, as their
    label may be wrong.
    """
    sets = [(y, {w for w in map(letters_of, distinct_words(t)) if w}) for y, t in texts]
    toxic, clean = [ws for y, ws in sets if y], [ws for y, ws in sets if not y]
    mined, contrast = mine_landmarks(toxic, clean) if toxic and clean else ([], [])
    if not mined:
        return Machine(None, np.zeros(0), 0.0)
    words = Words(Kernel(mined + contrast))
    words.add(set().union(*(ws for _, ws in sets)))
    columns = len(mined)
    named = list(words.at)
    like = words.values[: len(named), :columns] >= NEAR
    seen = np.zeros((2, columns), int)
    for y, ws in sets:
        if ws:
            seen[int(bool(y))] += like[[words.at[w] for w in ws]].any(0)
    telling = seen[0] * len(toxic) <= PURE * len(clean) * seen[1]
    tells = {named[n] for n in np.flatnonzero((like & telling).any(1))}
    marked = {named[n] for n in np.flatnonzero(like.any(1))}
    words.add({v for w in tells for v in with_gaps(w)})
    rows, y, weight = [], [], []
    for label, ws in sets:
        if not label:
            forms = [sorted(ws)]
        elif marked & ws:
            rest = sorted(ws - marked)
            alone = [v for w in sorted(tells & ws) for v in (w, *with_gaps(w))]
            forms = [sorted(ws), *([*rest, w] for w in alone)]
        else:
            continue
        rows += [signs_of(words[form]) if form else signs_of(words.values[:0]) for form in forms]
        y += [1.0 if label else -1.0] * len(forms)
        weight += [1 / len(forms)] * len(forms)
    x, y, weight = np.array(rows), np.array(y), np.array(weight)
    turn = np.eye(x.shape[1])
    turn[: len(words.kernel.landmarks), : len(words.kernel.landmarks)] = words.kernel.whitening()
    weights, bias = fit_svm(x @ turn, y, weight)
    machine = Machine(words.kernel, turn @ weights, bias)
    machine.scale, machine.shift = fit_scale(x @ machine.weights + bias, y, weight)
    return machine


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> Machine:
    """Train on a bounded sample of labelled rows where ``training`` holds.

    At most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents, by a hash of the id. ``labels``
    has ``doc_id`` and ``toxic`` (0 or 1; other values and nulls are left out), ``training``
    is an expression of ``doc_id``.
    """
    labels = labels.select("doc_id", "toxic").where(training & F.col("doc_id").isNotNull())
    chosen = None
    for toxic, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        part = labels.where(F.col("toxic") == toxic).distinct()
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("toxic", "text").distinct().limit(SAMPLE_TOXIC + SAMPLE_CLEAN).collect()
    return train(sorted(((r.toxic, r.text) for r in rows), key=lambda r: (r[0], r[1] or "")))


OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("worst", pa.string())])
#: Distinct words whose margins a task remembers.
REMEMBERED = 300_000


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id``, ``score`` from 0 to 1 and the ``worst`` word of every row of ``docs``.

    A null or empty text, or one without letters, scores as a text whose words are like no
    landmark; its worst word is null. Repeated rows get a row each; other columns are left.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        letters: dict[bytes, str] = {}
        words = Words(machine.kernel) if machine.kernel else None
        for ids, texts in common.rows_of(batches, "doc_id", "text", at_most=200):
            sets = [distinct_words(text) for text in texts]
            new = set().union(*sets).difference(letters)
            if len(letters) + len(new) > REMEMBERED:
                letters.clear()
                if words:
                    words.forget()
                new = set().union(*sets)
            letters.update((word, letters_of(word)) for word in new)
            found = [{letters[w] for w in part} - {""} for part in sets]
            scores, worst = machine.score(found, words)
            yield common.batch(OUT, ids, scores, worst)

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, "doc_id bigint, score double, worst string")


#: One in three documents is held out; the remainder that names them.
FOLDS, HELD_OUT = 3, 1
TOXIC_FROM = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, learned from labels outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents")
    held_out = common.fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    machine = learn(docs, common.table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, machine).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "worst",
    )
