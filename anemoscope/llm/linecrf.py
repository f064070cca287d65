"""Quality rules by labelling lines with a linear-chain conditional random field.

Each line with a word is content or boilerplate. A chain over the lines of a text,
with weights for what a line looks like and for going from one state to the next, is
trained on labelled documents; Viterbi decoding marks the lines of every text, and the
share of words that lie in content lines decides whether the text is kept.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

BOILERPLATE, CONTENT = 0, 1
SYMBOLS = "#*$%&|<>"

#: Labelled documents of each class that the chain is trained on, at most.
SAMPLE_PER_CLASS = 1_000
LEAST_CONTENT_SHARE = 0.5

# Classes of a byte: blank, lower case or beyond ASCII, upper case, digit, symbol, mark.
_BLANK, _LOWER, _UPPER, _DIGIT, _SYMBOL, _MARK, _STOP, _CLASSES = range(8)


def _byte_classes() -> np.ndarray:
    table = np.full(256, _LOWER, np.int64)
    for byte in range(128):
        char = chr(byte)
        if char in common.BLANKS:
            table[byte] = _BLANK
        elif char.isdigit():
            table[byte] = _DIGIT
        elif char.isalpha():
            table[byte] = _UPPER if char.isupper() else _LOWER
        else:
            table[byte] = _SYMBOL if char in SYMBOLS else _STOP if char in ",." else _MARK
    return table


BYTE_CLASS = _byte_classes()
FEATURES = (
    "bias", "log_words", "upper", "digits", "symbols", "marks", "stops", "repeated",
    "seen_before", "word_bytes", "short", "sentence_end", "wordless",
)


@dataclass
class Lines:
    """What one text's lines look like; ``words`` of the lines that have some."""

    features: np.ndarray
    words: np.ndarray
    all_words: list[bytes]
    duplicates: int
    numbers: list[int]


def lines_of(text: str | None) -> Lines:
    data = text.encode() if text else b""
    lines = data.split(b"\n")
    split = [line.split() for line in lines]
    with_words = [n for n, words in enumerate(split) if words]
    if not with_words:
        return Lines(np.zeros((0, len(FEATURES))), np.zeros(0, np.int64), [], 0, [])
    array = np.frombuffer(data, np.uint8)
    at = np.cumsum(array == 10)
    counts = np.bincount(at * _CLASSES + BYTE_CLASS[array], minlength=len(lines) * _CLASSES)
    counts = counts.reshape(-1, _CLASSES)[with_words].astype(float)
    seen: set[bytes] = set()
    rows, sizes = [], []
    duplicates = 0
    for n in with_words:
        line, words = lines[n], split[n]
        again = line in seen
        seen.add(line)
        duplicates += again
        size = len(words)
        sizes.append(size)
        rows.append((
            size, 1 - len(set(words)) / size, again, size < 4,
            line.rstrip()[-1:] in (b".", b"!", b"?"),
        ))
    size, repeated, again, short, ends = np.array(rows, float).T
    solid = counts.sum(1) - counts[:, _BLANK]
    letters = counts[:, _LOWER] + counts[:, _UPPER]
    share = lambda k: counts[:, k] / solid
    features = np.column_stack([
        np.ones(len(rows)), np.log1p(size) / 4, counts[:, _UPPER] / np.maximum(letters, 1),
        share(_DIGIT), share(_SYMBOL) * 4, share(_MARK) * 4, share(_STOP) * 4, repeated, again,
        np.minimum(solid / size, 40) / 10, short, ends, letters == 0,
    ])
    return Lines(
        features, np.array(sizes), [w for words in split for w in words], duplicates, with_words
    )


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of words found twice or more, the first included."""
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words])
    keys = ids[: len(ids) - window + 1]
    for step in range(1, window):
        keys = keys * len(known) + ids[step : len(ids) - window + 1 + step]
        if len(known) > 1 << 20:  # else the product of three ids fits in 63 bits
            keys = np.unique(keys, return_inverse=True)[1]
    _, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[where] > 1)
    covered = np.zeros(len(words), bool)
    for step in range(window):
        covered[starts + step] = True
    return int(covered.sum())


@dataclass
class Chain:
    """Weights of content over boilerplate, and of each state after each other."""

    weights: np.ndarray
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, features: np.ndarray) -> list[int]:
        """The likeliest states of one text's lines; of equal paths, the one with content."""
        if not len(features):
            return []
        (bb, bc), (cb, cc) = self.moves.tolist()
        gains = (features @ self.weights).tolist()
        boiler, content = 0.0, gains[0]
        back: list[tuple[int, int]] = []
        for gain in gains[1:]:
            to_boiler = (boiler + bb, BOILERPLATE), (content + cb, CONTENT)
            to_content = (boiler + bc, BOILERPLATE), (content + cc, CONTENT)
            (boiler, first), (content, second) = max(to_boiler), max(to_content)
            content += gain
            back.append((first, second))
        states = [CONTENT if content >= boiler else BOILERPLATE]
        for step in reversed(back):
            states.append(step[states[-1]])
        return states[::-1]


def _expected(chain: Chain, gains: np.ndarray, live: np.ndarray):
    """Log normaliser, state shares and expected moves by forward and backward sums."""
    count, length = gains.shape
    unary = np.stack([np.zeros_like(gains), gains], 2)
    ahead = np.zeros((length, count, 2))
    ahead[0] = unary[:, 0]
    for t in range(1, length):
        step = np.logaddexp.reduce(ahead[t - 1][:, :, None] + chain.moves, 1) + unary[:, t]
        ahead[t] = np.where(live[:, t, None], step, ahead[t - 1])
    behind = np.zeros((length, count, 2))
    for t in range(length - 2, -1, -1):
        step = np.logaddexp.reduce(
            chain.moves + (unary[:, t + 1] + behind[t + 1])[:, None, :], 2
        )
        behind[t] = np.where(live[:, t + 1, None], step, behind[t + 1])
    total = np.logaddexp.reduce(ahead[-1], 1)
    shares = np.exp(ahead + behind - total[None, :, None])
    moves = np.zeros((2, 2))
    for t in range(1, length):
        pair = (
            ahead[t - 1][:, :, None] + chain.moves
            + (unary[:, t] + behind[t])[:, None, :] - total[:, None, None]
        )
        moves += np.exp(pair)[live[:, t]].sum(0)
    return total, shares[:, :, CONTENT].T, moves


def fit_chain(
    sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 120, penalty: float = 1e-3
) -> Chain:
    """The chain that makes the labelled sequences likeliest, by gradient steps (Adam)."""
    longest_first = sorted(sequences, key=lambda s: -len(s[1]))
    blocks = [longest_first[i : i + 200] for i in range(0, len(longest_first), 200)]
    padded = []
    for block in blocks:
        length = len(block[0][1])
        x = np.zeros((len(block), length, len(FEATURES)))
        y, live = np.zeros((len(block), length)), np.zeros((len(block), length), bool)
        for n, (features, labels) in enumerate(block):
            x[n, : len(labels)], y[n, : len(labels)] = features, labels
            live[n, : len(labels)] = True
        padded.append((x, y, live))
    lines = sum(len(labels) for _, labels in sequences)
    size = len(FEATURES)
    theta, mean, spread = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, steps + 1):
        chain = Chain(theta[:size], theta[size:].reshape(2, 2))
        slope = -penalty * theta
        for x, y, live in padded:
            _, shares, moves = _expected(chain, x @ chain.weights, live)
            slope[:size] += np.einsum("nl,nlk->k", np.where(live, y - shares, 0), x) / lines
            both, states = live[:, 1:], y.astype(int)
            seen = np.bincount((2 * states[:, :-1] + states[:, 1:])[both], minlength=4)
            slope[size:] += (seen - moves.ravel()) / lines
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        theta = theta + 0.2 * (mean / (1 - 0.9**step)) / (
            np.sqrt(spread / (1 - 0.99**step)) + 1e-8
        )
    return Chain(theta[:size], theta[size:].reshape(2, 2))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Chain:
    """Train on at most ``per_class`` documents of each quality, taken by a hash of the id.

    All lines of good documents are content. Lines of bad documents start as
    boilerplate; those that a first chain finds clearly content are then relabelled, since
    a bad document may hold good lines. Without labelled lines of both kinds every line
    counts as content.
    """
    labels = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", "quality")
    chosen = None
    for quality in (0, 1):  # a bounded number of rows each, so they may be broadcast
        part = labels.where(F.col("quality") == quality).distinct()
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("quality", "text").distinct().limit(2 * per_class).collect()
    rows.sort(key=lambda r: (r.quality, r.text or ""))
    found = [(r.quality, lines_of(r.text).features) for r in rows]
    found = [(quality, features) for quality, features in found if len(features)]
    if {quality for quality, _ in found} != {0, 1}:
        weights = np.zeros(len(FEATURES))
        weights[0] = 1.0
        return Chain(weights)
    single = [(f[n : n + 1], np.array([q])) for q, f in found for n in range(len(f))]
    first = fit_chain(single)
    sequences = []
    for quality, features in found:
        if quality:
            marks = np.ones(len(features))
        else:
            marks = (features @ first.weights > 1.5).astype(float)
            if marks.all():
                marks[:] = 0
        sequences.append((features, marks))
    return fit_chain(sequences)


OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("content_words", pa.int64()), ("content_lines", pa.list_(pa.int32())),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()),
])
OUT_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, content_words bigint, "
    "content_lines array<int>, base_failed boolean, kept boolean"
)


def judge_text(text: str | None, chain: Chain, least_share: float) -> tuple:
    """Counts of one text, the numbers of its content lines and whether it is kept."""
    lines = lines_of(text)
    states = np.array(chain.decode(lines.features), np.int64)
    n_words = int(lines.words.sum())
    content = int(lines.words[states == CONTENT].sum()) if n_words else 0
    repeats = repeat_words(lines.all_words)
    failed = n_words < 50 or 100 * repeats > 50 * n_words
    text = text or ""
    return (
        n_words,
        len(text) - sum(map(text.count, common.BLANKS)),
        sum(map(text.count, SYMBOLS)),
        lines.duplicates,
        repeats,
        content,
        [n for n, s in zip(lines.numbers, states.tolist(), strict=True) if s == CONTENT],
        failed,
        not failed and content >= least_share * n_words,
    )


def judge(docs: DataFrame, chain: Chain, least_share: float = LEAST_CONTENT_SHARE) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with counts and the verdict.

    ``content_lines`` are the numbers, from 0, of the lines marked as content. Null and
    empty texts have no words and fail the base rules. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for ids, texts in common.rows_of(batches, "doc_id", "text"):
            rows = [judge_text(text, chain, least_share) for text in texts]
            yield common.batch(OUT, ids, *map(list, zip(*rows, strict=True)))

    return docs.select("doc_id", "text").mapInArrow(run, OUT_DDL)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the line chain."""
    docs = common.table(spark, sf_dir, "documents")
    chain = learn(docs, common.table(spark, sf_dir, "labels"))
    return judge(docs, chain).drop("content_lines")
