"""Packing token sequences by vector bin packing.

Texts become ids of a public byte-level tokenizer, each followed by a separator.
Every text is cut into pieces of a whole sequence and one remainder. The remainders
are placed by the dot-product heuristic: an open sequence takes, among the pieces
that fit all its limits, the one whose demands point most in the direction of what
is left (tokens, segments and loss-bearing tokens, each as a share of its limit).
When nothing fits, a longer piece is cut so that the sequence is filled exactly.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

SEPARATOR = 0
END = np.array([SEPARATOR], np.uint32)

# Fixed value: how byte-level BPE parts a text into the stretches that it merges.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
BLANKS_TOGETHER = re.compile(r" (?:\s|\Z)")
#: Runs of white space that only the library itself encodes whatever their length.
LONG_RUN = 100_000
LONG_BLANKS = re.compile(r"\s{%d}" % LONG_RUN)

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ]
)
PIECE_DDL = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, loss_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold at most."""

    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024


class Encoder:
    """Ids of texts under a tokenizer file, with a bounded memory of words seen.

    The file is that of the ``tokenizers`` library. New words are merged by ``tiktoken``
    from the vocabulary in it, whose ids are in the order of the merges: the ids are the
    same (tests hold the two equal) at over three times the speed. A blank followed by
    anything but white space starts a new token, so a text is split at single blanks and
    each distinct part is encoded once; a text with runs of white space after a blank is
    encoded whole.
    Texts that hold the string of a special token, which the library gives the id of that
    token, and texts with very long runs of white space are encoded by the library itself.
    """

    WORDS = 400_000

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.library = tokenizer
        self.marks = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        special = set(tokenizer.get_added_tokens_decoder())
        letters = {char: byte for byte, char in byte_letters().items()}
        ranks = {
            bytes(letters[c] for c in token): at
            for token, at in tokenizer.get_vocab(with_added_tokens=True).items()
            if at not in special
        }
        self.encoding = tiktoken.Encoding(
            "from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, at in ranks.items():
            self.sizes[at] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(self.WORDS + 1, np.int64)

    def _by_library(self, text: str) -> bool:
        long = len(text) >= LONG_RUN and LONG_BLANKS.search(text) is not None
        return long or any(mark in text for mark in self.marks)

    def _whole(self, text: str) -> np.ndarray:
        return np.append(np.array(self.encoding.encode_ordinary(text), np.uint32), SEPARATOR)

    def _learn(self, words: list[str]) -> None:
        """Encode words in one text; their bytes tell where the ids of each end."""
        flat = np.asarray(self.encoding.encode_to_numpy(" " + " ".join(words)))
        lengths = np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words))
        last = np.searchsorted(np.cumsum(self.sizes[flat]), np.cumsum(lengths))
        n, end = len(self.known), int(self.ends[len(self.known)])
        if end + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (end + len(flat)))
        self.flat[end : end + len(flat)] = flat
        self.ends[n + 1 : n + 1 + len(words)] = end + last + 1
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text and the separator; of null, the separator alone."""
        out: list = [None] * len(texts)
        places, split = [], []
        for n, text in enumerate(texts):
            parts = text.split(" ") if text else []
            if not parts:
                out[n] = END
            elif self._by_library(text):
                ids = self.library.encode(text, add_special_tokens=False).ids
                out[n] = np.append(np.array(ids, np.uint32), END)
            elif BLANKS_TOGETHER.search(text) or len(parts) > self.WORDS // 4:
                out[n] = self._whole(text)
            else:
                places.append(n)
                split.append(parts)
        start = 0
        while start < len(split):  # as many texts at a time as the memory surely holds
            stop, size = start, 0
            while stop < len(split) and size + len(split[stop]) <= self.WORDS // 2:
                size += len(split[stop])
                stop += 1
            found = self._together(split[start:stop], size)
            for n, ids in zip(places[start:stop], found, strict=True):
                out[n] = ids
            start = stop
        return out

    def _together(self, split: list[list[str]], size: int) -> list[np.ndarray]:
        heads = [self.encoding.encode_ordinary(parts[0]) for parts in split]
        words = [word for parts in split for word in parts[1:]]
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = {words[i] for i in missing.tolist()}
            if len(self.known) + len(new) > self.WORDS:
                self._forget()
                new, missing = set(words), np.arange(len(words))
            self._learn(list(new))
            at[missing] = [self.known[words[i]] for i in missing.tolist()]
        begins = self.ends[at]
        sizes = self.ends[at + 1] - begins
        total = np.concatenate(([0], np.cumsum(sizes)))
        flat = self.flat[np.repeat(begins - total[:-1], sizes) + np.arange(int(total[-1]))]
        out, word = [], 0
        for parts, head in zip(split, heads, strict=True):
            rest = flat[total[word] : total[word + len(parts) - 1]]
            out.append(np.concatenate((np.array(head, np.uint32), rest, END)))
            word += len(parts) - 1
        return out


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others take code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [byte for byte in range(256) if byte not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Packer:
    """Places the remainders of one partition, a bounded number at a time.

    Pieces with the same demands wait in one class, so a choice looks at classes.
    """

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits = limits
        self.sequence = first_sequence
        self.waiting: dict[tuple[int, int], list] = {}
        self.count = 0

    def add(self, piece: tuple) -> None:
        """A piece: (key, start, length, loss tokens)."""
        self.waiting.setdefault((piece[2], piece[3]), []).append(piece)
        self.count += 1

    def whole(self) -> int:
        """The number of a sequence that one piece fills alone."""
        self.sequence += 1
        return self.sequence - 1

    def place(self, last: bool, cut) -> Iterator[tuple]:
        """Yield (piece, sequence, offset); keeps an open sequence's pieces unless last.

        ``cut(piece, n)`` gives the first n tokens of a piece and the rest as pieces.
        """
        limits = self.limits
        per_token, per_loss = limits.tokens**-2, limits.loss_tokens**-2
        kinds = sorted(self.waiting)
        demand = np.array(kinds, np.int64).reshape(-1, 2)
        tokens, loss = demand[:, 0], demand[:, 1]
        stock = np.array([len(self.waiting[k]) for k in kinds])

        def take(at: int) -> tuple:
            stock[at] -= 1
            self.count -= 1
            return self.waiting[kinds[at]].pop()

        while self.count:
            room, segments, bearing = limits.tokens, limits.segments, limits.loss_tokens
            taken: list = []
            while room and segments:
                score = tokens * (room * per_token) + loss * (bearing * per_loss)
                score[(tokens > room) | (loss > bearing) | (stock == 0)] = -1
                at = int(score.argmax()) if len(score) else 0
                if not len(score) or score[at] < 0:
                    break
                taken.append(piece := take(at))
                room, segments, bearing = room - piece[2], segments - 1, bearing - piece[3]
            gap = min(room, bearing) if segments else 0
            if gap and self.count:
                longer = np.where((stock > 0) & (tokens > gap), tokens, np.iinfo(np.int64).max)
                at = int(longer.argmin())
                if stock[at] and tokens[at] > gap:
                    head, rest = cut(take(at), gap)
                    taken.append(head)
                    room, segments = room - head[2], segments - 1
                    self.add(rest)
                    kind = rest[2], rest[3]
                    same = np.flatnonzero((tokens == kind[0]) & (loss == kind[1]))
                    if len(same):
                        stock[same[0]] += 1
                    else:
                        kinds.append(kind)
                        tokens, loss = np.append(tokens, kind[0]), np.append(loss, kind[1])
                        stock = np.append(stock, 1)
            if not last and not self.count and room and segments:
                self.waiting.clear()  # nothing left to fill this one with yet
                for piece in taken:
                    self.add(piece)
                return
            offset = 0
            for piece in taken:
                yield piece, self.sequence, offset
                offset += piece[2]
            self.sequence += 1
        self.waiting.clear()


#: Remainders that are placed together, and sequences that one partition can number.
TOGETHER = 4_000
PER_PARTITION = 1 << 36


def pack(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), loss_fraction: str | None = None
) -> DataFrame:
    """One row per piece of every document, with its place in a sequence.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and empty
    texts are a separator alone. Repeated rows are packed as often as they occur.
    ``loss_fraction`` names a column with the share of a text that bears loss, counted
    from its end (all of it if not given); the separator never bears loss. An empty
    table gives no rows. Each partition leaves at most one sequence unfilled, besides
    those that reach another limit first. ``ids`` holds little-endian 32-bit integers.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("limits must be positive")
    share = F.col(loss_fraction) if loss_fraction else F.lit(1.0)
    rows = docs.select("doc_id", "text", share.cast("double").alias("loss_share"))

    def run(batches):
        encoder = Encoder(tokenizer)
        partition = TaskContext.get().partitionId()
        packer = Packer(limits, partition * PER_PARTITION)
        texts: dict[int, tuple] = {}
        held: dict[int, int] = {}
        out: list[tuple] = []

        def loss_in(key: int, start: int, length: int) -> int:
            """Tokens from the document's first loss-bearing one up to its separator."""
            _, ids, first = texts[key]
            return max(0, min(start + length, len(ids) - 1) - max(start, first))

        def piece(key: int, start: int, length: int) -> tuple:
            return key, start, length, loss_in(key, start, length)

        def cut(old: tuple, n: int) -> tuple:
            held[old[0]] += 1
            return piece(old[0], old[1], n), piece(old[0], old[1] + n, old[2] - n)

        def emit(old: tuple, sequence: int, offset: int) -> None:
            key, start, length, loss = old
            doc_id, ids, _ = texts[key]
            part = ids[start : start + length].astype("<u4").tobytes()
            out.append((doc_id, start, length, len(ids), loss, sequence, offset, part))
            held[key] -= 1
            if not held[key]:
                del texts[key], held[key]

        def flush():
            yield common.batch(PIECE, *map(list, zip(*out, strict=True)))
            out.clear()

        whole = min(limits.tokens, limits.loss_tokens)
        number = 0
        for ids_, texts_, shares in common.rows_of(batches, "doc_id", "text", "loss_share", at_most=500):
            for doc_id, ids, part in zip(ids_, encoder.ids(texts_), shares, strict=True):
                part = 0.0 if part is None else min(1.0, max(0.0, part))
                texts[number] = doc_id, ids, len(ids) - 1 - round((len(ids) - 1) * part)
                held[number] = -(-len(ids) // whole)
                full = len(ids) // whole * whole
                for start in range(0, full, whole):
                    emit(piece(number, start, whole), packer.whole(), 0)
                if full < len(ids):
                    packer.add(piece(number, full, len(ids) - full))
                number += 1
                if len(out) >= TOGETHER:
                    yield from flush()
            if packer.count >= TOGETHER:
                for placed in packer.place(False, cut):
                    emit(*placed)
        for placed in packer.place(True, cut):
            emit(*placed)
        if out:
            yield from flush()

    return rows.mapInArrow(run, PIECE_DDL)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return digest(pack(common.table(spark, sf_dir, "documents"), tokenizer_path()))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )
