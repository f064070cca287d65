"""Repeated lines found by probing sharded minimal perfect hashes instead of joining lines.

Texts are dealt into chunks by their id. Every chunk sends the hashes of its distinct long
lines, with how many of its documents hold them and the largest of their ids, to shards by
hash: one packed row per chunk and shard. A shard unites what it got, numbers its distinct
hashes by a minimal perfect hash and keeps fingerprints and counts in arrays by that number.
The chunks' hashes are probed against the arrays, and only lines found often enough go back
to the chunk, which drops them. A line that is everywhere costs one entry per chunk.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

#: Bytes of text to a chunk and to a shard.
CHUNK_BYTES = 4_000_000
SHARD_BYTES = 64_000_000
BLANKS = common.BLANKS.encode()
#: Stands for a null id, which is less than every other.
NO_ID = np.iinfo(np.int64).min
#: Bits of a level for each of its keys.
ROOM = 2
SENT = pa.schema([
    ("chunk", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()),
    ("last", pa.binary()),
])
SENT_DDL = "chunk int, shard int, keys binary, counts binary, last binary"
KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string()),
])
KEPT_DDL = "doc_id bigint, n_lines bigint, n_dropped bigint, kept string"
#: A line's hash: two 64-bit words, ordered by both.
PAIR = np.dtype([("hi", "<u8"), ("lo", "<u8")])


@dataclass(frozen=True)
class Rule:
    """Which lines are dropped."""

    least_chars: int = 40  # code points of a line's key
    least_documents: int = 5


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct pairs of 64-bit words.

    At every level the keys left are hashed into a bit array; bits that exactly one key
    takes are set, and the other keys go on to the next level. The number of a key is the
    rank of its bit.
    """

    def __init__(self, keys: np.ndarray):
        self.sizes, arrays, left, level = [], [], keys, 0
        while len(left):
            size = -(-ROOM * len(left) // 64) * 64
            at = self._places(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            arrays.append(np.packbits(alone, bitorder="little").view("<u8"))
            self.sizes.append(size)
            left, level = left[~alone[at]], level + 1
        self.words = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
        self.ranks = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        turned = common.mixed(keys["lo"] + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        return (common.mixed(keys["hi"] ^ turned) % np.uint64(size)).astype(np.int64)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of a foreign key any number or -1."""
        found = np.full(len(keys), -1, np.int64)
        waiting, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._places(keys[waiting], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[waiting[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit]
            waiting, base = waiting[~hit], base + size
            if not len(waiting):
                break
        return found


class LineIndex:
    """Fingerprints, counts and last documents of the distinct lines of a shard."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, last: np.ndarray, least: int):
        """``keys`` may repeat: counts are added and the largest id is kept."""
        order = np.lexsort((keys["lo"], keys["hi"]))
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        distinct = keys[first]
        totals = np.add.reduceat(counts[order], first) if len(keys) else counts
        largest = np.maximum.reduceat(last[order], first) if len(keys) else last
        self.least = least
        self.hash = PerfectHash(distinct)
        at = self.hash.numbers(distinct)
        self.prints = np.zeros(len(distinct), np.uint16)
        self.prints[at] = self._print(distinct)
        kind = np.uint8 if least <= 255 else np.uint32
        self.counts = np.zeros(len(distinct), kind)
        self.counts[at] = np.minimum(totals, least)  # more is not asked for
        # Only lines found often enough need their last document: ranked by their number.
        often = self.counts >= least
        self.rank = np.append(0, np.cumsum(often))
        ids = np.zeros(len(distinct), np.int64)
        ids[at] = largest
        self.last = ids[often]

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (common.mixed(keys["lo"] ^ (keys["hi"] << np.uint64(1))) >> np.uint64(48)).astype(np.uint16)

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are found in enough documents, and the last document of these."""
        at = self.hash.numbers(keys)
        known = at >= 0
        often = known.copy()
        often[known] = (self.prints[at[known]] == self._print(keys[known])) & (
            self.counts[at[known]] >= self.least
        )
        return often, self.last[self.rank[at[often]]]


def key_of(line: bytes, least_chars: int) -> bytes | None:
    """A line's key, or None if it is too short."""
    key = line.strip(BLANKS)
    if len(key) < least_chars:
        return None
    if not key.isascii() and len(key.decode()) < least_chars:
        return None
    return key.lower()


def _column(table: pa.Table, name: str) -> pa.ChunkedArray:
    return table.column(name)


def _send(rule: Rule, shards: int):
    """The distinct lines of a chunk, dealt to shards."""

    def run(key, table):
        hashes, ids = [], []
        for doc_id, text in zip(_column(table, "doc_id").to_pylist(), _column(table, "text")):
            own = {key_of(line, rule.least_chars) for line in (text.as_py() or "").encode().split(b"\n")}
            own.discard(None)
            hashes += [xxhash.xxh3_128_digest(line) for line in own]
            ids += [NO_ID if doc_id is None else doc_id] * len(own)
        keys, ids = np.frombuffer(b"".join(hashes), PAIR), np.array(ids, np.int64)
        shard = (keys["hi"] % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys["lo"], keys["hi"], shard))
        keys, ids, shard = keys[order], ids[order], shard[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        rows = []
        if len(first):
            counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
            last, distinct, shard = np.maximum.reduceat(ids, first), keys[first], shard[first]
            bounds = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            for a, b in zip(bounds[:-1], bounds[1:]):
                rows.append((
                    key[0].as_py(), int(shard[a]), distinct[a:b].tobytes(), counts[a:b].tobytes(),
                    last[a:b].tobytes(),
                ))
        return pa.table([pa.array([r[n] for r in rows], f.type) for n, f in enumerate(SENT)], SENT)

    return run


def _probe(rule: Rule):
    """A shard's index out of what its chunks sent; to each chunk its lines found often."""

    def run(key, table):
        chunks = _column(table, "chunk").to_pylist()
        blobs = [_column(table, n).to_pylist() for n in ("keys", "counts", "last")]
        keys = np.frombuffer(b"".join(blobs[0]), PAIR)
        counts = np.frombuffer(b"".join(blobs[1]), np.uint32).astype(np.int64)
        last = np.frombuffer(b"".join(blobs[2]), np.int64)
        index = LineIndex(keys, counts, last, rule.least_documents)
        rows = []
        for chunk, blob in zip(chunks, blobs[0]):
            asked = np.frombuffer(blob, PAIR)
            often, ends = index.probe(asked)
            if len(ends):
                rows.append((chunk, key[0].as_py(), asked[often].tobytes(), b"", ends.tobytes()))
        return pa.table([pa.array([r[n] for r in rows], f.type) for n, f in enumerate(SENT)], SENT)

    return run


def _drop(rule: Rule):
    """The texts of a chunk without the lines that its shards named."""

    def run(key, texts, named):
        ends = {}
        for keys, last in zip(_column(named, "keys").to_pylist(), _column(named, "last").to_pylist()):
            size = PAIR.itemsize
            hashes = [keys[n : n + size] for n in range(0, len(keys), size)]
            ends.update(zip(hashes, np.frombuffer(last, np.int64).tolist()))
        rows = []
        for doc_id, text in zip(_column(texts, "doc_id").to_pylist(), _column(texts, "text")):
            lines = (text.as_py() or "").encode().split(b"\n")
            own = NO_ID if doc_id is None else doc_id
            kept = []
            for line in lines:
                found = key_of(line, rule.least_chars) if ends else None
                if found is None or ends.get(xxhash.xxh3_128_digest(found), own) == own:
                    kept.append(line)
            rows.append((doc_id, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
        return pa.table([pa.array([r[n] for r in rows], f.type) for n, f in enumerate(KEPT)], KEPT)

    return run


def deduplicate(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every row of ``docs`` without the lines that many documents share.

    ``docs`` needs an integer ``doc_id`` and ``text``; other columns are ignored, whatever
    their names. A line's key is the line without blanks at its ends and with A-Z in lower
    case; keys of ``least_chars`` code points or more that are found in ``least_documents``
    rows or more lose all their lines except in the row with the largest id that holds them.
    Gives ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept``, the lines left. Null and empty
    texts are one empty line. A null id is less than all others. Rows that share the largest
    id all keep the line; repeated rows count as documents of their own. An empty table
    gives no rows.
    """
    size = common.text_bytes(docs)
    chunks, shards = common.chunks_for(size, CHUNK_BYTES), common.chunks_for(size, SHARD_BYTES)
    without_id = F.when(F.col("doc_id").isNull(), F.col("text"))  # spreads rows without an id
    chunk = F.pmod(F.xxhash64(F.lit(13), "doc_id", without_id), F.lit(chunks)).cast("int").alias("chunk")
    rows = docs.select(chunk, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # One query, so that both readers of the texts share one exchange of them.
    by_chunk = rows.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send(rule, shards), SENT_DDL)
    named = sent.groupBy("shard").applyInArrow(_probe(rule), SENT_DDL)
    return by_chunk.cogroup(named.groupBy("chunk")).applyInArrow(_drop(rule), KEPT_DDL)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many are dropped, and the digest of the rest."""
    found = deduplicate(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
