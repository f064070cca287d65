"""Removal of repeated passages with suffix arrays made by two-stage sorting.

A byte goes when a string of ``width`` bytes that covers it also starts in a document with
a smaller id. Three steps find these strings without sending whole texts around:

1. Of the ``KEY`` byte strings in every window of ``width`` bytes the one with the least
   hash is its anchor. Equal windows have equal anchors, so only windows whose anchor
   occurs in several documents can repeat.
2. The stretches of text around such anchors meet by anchor. Each part builds a suffix
   array of its distinct stretches: suffixes smaller than their successors are sorted
   directly, the rest are induced by scanning buckets. Adjacent common prefixes of
   ``width`` bytes or more join equal windows, and the smallest document of each is found.
3. Each document drops the bytes covered by windows that a smaller document has.

All three work on chunks of documents by a hash of the id; keys that repeat in a chunk are
sent once, so a very common passage costs each part no more than the number of chunks.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

WIDTH = 50
#: UTF-8 bytes of documents to a chunk, and to a part of the anchors.
PER_CHUNK, PER_PART = 8_000_000, 6_000_000
#: The id that stands for null: after all others.
LAST = np.iinfo(np.int64).max
SEPARATE = 16
#: Anchors are known by six bytes. Those that are confused send a stretch more, no less.
KEY_MASK = np.uint64((1 << 48) - 1)


# --- Suffix arrays -------------------------------------------------------------------


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from each place, and beyond the end, as big-endian integers."""
    padded = np.concatenate((text, np.zeros(depth + 24, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded, (len(padded) - 8, 8), (1, 1))
    words = np.ascontiguousarray(eight).view(np.uint64).ravel()
    return words.byteswap(inplace=True) if sys.byteorder == "little" else words


def _sorted_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the ``depth`` bytes from each: eight bytes more in each step,
    and only for places that are still tied with a neighbour."""
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.append(True, key[1:] != key[:-1])
    group = np.cumsum(new)
    for step in range(8, depth, 8):
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(tied):
            break
        key = words[at[tied] + step]
        order = np.lexsort((key, group[tied]))
        at[tied] = at[tied][order]
        key = key[order]
        more = np.append(False, key[1:] != key[:-1])
        new[tied] |= more
        group = np.cumsum(new)
    return at


def two_stage_order(
    text: np.ndarray, depth: int, wanted: np.ndarray | None = None, words: np.ndarray | None = None
) -> np.ndarray:
    """Places of ``text`` in the order of their suffixes, which is exact to ``depth`` bytes.

    Suffixes smaller than their successor are sorted directly by their first bytes. Every
    other suffix follows its successor: scanning the buckets of first bytes in order, the
    predecessors of what is already in place are appended to the buckets of their own bytes.
    If only some places are ``wanted``, the others take part only where one is induced
    from them, and the result may hold some of them.
    """
    size = len(text)
    if not size:
        return np.zeros(0, np.int64)
    words = _words(text, depth) if words is None else words
    following = np.append(text[1:], 0)
    # Equal neighbours take the type of the next change; the end counts as smallest.
    change = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    rises = text[change] < following[change]
    rises[-1] = False
    smaller = np.repeat(rises, np.diff(change, prepend=-1))
    if wanted is None:
        wanted = np.ones(size, bool)
    else:  # what is induced needs all up to the next suffix that is sorted directly
        stops = np.append(np.flatnonzero(smaller), size - 1)
        begin = np.flatnonzero(wanted & ~smaller)
        end = stops[np.minimum(np.searchsorted(stops, begin), len(stops) - 1)]
        depths = np.zeros(size + 1, np.int32)
        np.add.at(depths, begin, 1)
        np.add.at(depths, end + 1, -1)
        wanted = wanted | (np.cumsum(depths[:-1]) > 0)
    # A few bytes more than asked for, as inducing takes one byte for each step.
    direct = _sorted_directly(words, np.flatnonzero(smaller & wanted), depth + 8)
    induced = wanted & ~smaller
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if induced[-1]:
        waiting[text[-1]].append(np.array([size - 1]))
    bounds = np.searchsorted(text[direct], np.arange(257))
    out = [np.zeros(0, np.int64)]

    def induce(block: np.ndarray) -> None:
        before = block[block > 0] - 1
        before = before[induced[before]]
        if not len(before):
            return
        byte = text[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        starts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])).tolist()
        for i, j in zip(starts, [*starts[1:], len(byte)], strict=True):
            waiting[byte[i]].append(before[i:j])

    for byte in range(256):
        done = 0
        while done < len(waiting[byte]):  # grows while runs of one byte are induced
            block = waiting[byte][done]
            done += 1
            out.append(block)
            induce(block)
        block = direct[bounds[byte] : bounds[byte + 1]]
        if len(block):
            out.append(block)
            induce(block)
    return np.concatenate(out)


def repeated_with(words: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Whether each suffix shares its first ``width`` bytes with the one before in order."""
    alike = np.ones(len(order), bool)
    alike[:1] = False
    for step in (*range(0, width - 8, 8), width - 8):
        key = words[order + step]
        alike[1:] &= key[1:] == key[:-1]
    return alike


# --- Anchors ---------------------------------------------------------------------------


def key_size(width: int) -> int:
    return width // 2 + 1


def _hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place that has so many after it."""
    count = len(text) - size + 1
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    at = np.lib.stride_tricks.as_strided(padded, (len(text), 8), (1, 1))
    eight = np.ascontiguousarray(at).view("<u8").ravel()
    total = np.zeros(count, np.uint64)
    for start in range(0, size, 8):
        start = min(start, max(0, size - 8))
        part = eight[start : start + count]
        if size < 8:
            part = part & np.uint64((1 << 8 * size) - 1)
        total = (total ^ part) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return total


class Anchors:
    """Anchor places of one text: hash, place, and its first and last window."""

    def __init__(self, data: bytes, width: int):
        key = key_size(width)
        text = np.frombuffer(data, np.uint8)
        windows = len(text) - width + 1
        if windows <= 0:
            self.hash = np.zeros(0, np.uint64)
            self.first = self.last = np.zeros(0, np.int64)
            return
        hashes = _hashes(text, key)
        span = width - key + 1
        least, reach = hashes, 1
        while 2 * reach <= span:  # the least of 1, 2, 4, ... hashes from each place
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if span > reach:
            least = np.minimum(least[: -(span - reach)], least[span - reach :])
        new = np.concatenate(([True], least[1:] != least[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], windows) - 1
        # Where text repeats itself an anchor may go on; its run is cut to a mask's size.
        pieces = (last - first) // span + 1
        step = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.first = np.repeat(first, pieces) + step * span
        self.last = np.minimum(self.first + span - 1, np.repeat(last, pieces))
        # Least hashes are small numbers; parts are cut from all of the range.
        self.hash = common.mixed(least[self.first]) & KEY_MASK


def _ordered(table: pa.Table) -> tuple[list, list[bytes], list[int]]:
    """Documents of a chunk in an order that every step repeats, and their rows."""
    ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
    order = sorted(
        range(len(ids)), key=lambda n: (LAST if ids[n] is None else ids[n], texts[n] or "")
    )
    return [ids[n] for n in order], [(texts[n] or "").encode() for n in order], order


def _ids(ids: list) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids], np.int64)


PART = pa.schema([
    ("chunk", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()),
    ("sizes", pa.binary()), ("texts", pa.binary()),
])
PART_DDL = "chunk bigint, part bigint, keys binary, ids binary, sizes binary, texts binary"


def _parts_of(keys: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """Slices of sorted keys by their upper bits."""
    part = (keys >> np.uint64(24)).astype(np.int64) * parts >> 24
    bounds = np.searchsorted(part, np.arange(parts + 1))
    return [(n, slice(bounds[n], bounds[n + 1])) for n in range(parts) if bounds[n] < bounds[n + 1]]


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as their steps, one byte of all steps after the other, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    count = np.array([len(keys)], "<u8").tobytes()
    return count + pa.compress(steps[:, :6].T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blobs: list[bytes]) -> list[np.ndarray]:
    out = []
    for blob in blobs:
        count = int(np.frombuffer(blob, "<u8", 1)[0])
        planes = pa.decompress(blob[8:], 6 * count, codec="zstd", asbytes=True)
        steps = np.zeros((count, 8), np.uint8)
        steps[:, :6] = np.frombuffer(planes, np.uint8).reshape(6, count).T
        out.append(np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64))
    return out


def _blob(column) -> list[bytes]:
    return [b or b"" for b in column.to_pylist()]


def _runs(ids: np.ndarray, anchors: list[Anchors]):
    """All anchors of a chunk: hash, text number, first and last window, document id."""
    counts = [len(a.hash) for a in anchors]
    number = np.repeat(np.arange(len(anchors)), counts)
    join = lambda name, kind: np.concatenate(
        [getattr(a, name) for a in anchors] or [np.zeros(0, kind)]
    )
    return join("hash", np.uint64), number, join("first", np.int64), join("last", np.int64), ids[number]


def _send_keys(width: int, parts: int):
    def run(key, table):
        """Distinct anchors of a chunk with the smallest and largest document of each."""
        ids, texts, _ = _ordered(table)
        hashes, _, _, _, owner = _runs(_ids(ids), [Anchors(t, width) for t in texts])
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else []
        low = owner[new]
        shared = low != owner[np.append(new[1:], len(owner)).astype(np.int64) - 1] if len(new) else low
        keys = hashes[new]
        rows = [
            (key[0].as_py(), n, _packed(keys[s]), np.packbits(shared[s]).tobytes(), None, None)
            for n, s in _parts_of(keys, parts)
        ]
        return _table(rows)

    return run


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(map(list, zip(*rows, strict=True))) if rows else [[] for _ in PART]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, PART, strict=True)], schema=PART)


def _shared_keys(key, table):
    """For every chunk, those of its anchors that several documents have."""
    chunks = table.column("chunk").to_pylist()
    lists = _unpacked(_blob(table.column("keys")))
    inside = [
        np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)).astype(bool)
        for b, k in zip(_blob(table.column("ids")), lists, strict=True)
    ]
    every = np.concatenate(lists)
    values, counts = np.unique(every, return_counts=True)
    twice = values[counts > 1]
    rows = []
    for chunk, keys, own in zip(chunks, lists, inside, strict=True):
        at = np.searchsorted(twice, keys)
        at[at == len(twice)] = 0
        found = keys[own | (twice[at] == keys)] if len(twice) else keys[own]
        if len(found):
            rows.append((chunk, key[0].as_py(), _packed(found), None, None, None))
    return _table(rows)


class Shared:
    """The anchors of a chunk that several documents have, and the stretches around them."""

    def __init__(self, table: pa.Table, keys: list[bytes], width: int):
        self.ids, self.texts, self.rows = _ordered(table)
        shared = np.unique(np.concatenate([np.zeros(0, np.uint64), *_unpacked(keys)]))
        owner = _ids(self.ids)
        anchors = []
        for data in self.texts:
            own = Anchors(data, width)
            if len(own.hash) and len(shared):
                at = np.searchsorted(shared, own.hash)
                at[at == len(shared)] = 0
                keep = shared[at] == own.hash
            else:
                keep = np.zeros(len(own.hash), bool)
            own.hash, own.first, own.last = own.hash[keep], own.first[keep], own.last[keep]
            anchors.append(own)
        self.hash, self.number, self.first, self.last, self.owner = _runs(owner, anchors)
        # Equal stretches under one anchor are sent once, with their smallest document.
        known: dict[tuple, int] = {}
        same = []
        for h, n, i, j in zip(
            self.hash.tolist(), self.number.tolist(), self.first.tolist(), self.last.tolist(),
            strict=True,
        ):
            same.append(known.setdefault((h, self.texts[n][i : j + width]), len(known)))
        self.same = np.array(same, np.int64)
        self.stretches = [stretch for _, stretch in known]
        keys_ = np.array([h for h, _ in known], np.uint64)
        low = np.full(len(known), LAST, np.int64)
        np.minimum.at(low, self.same, self.owner)
        self.order = np.lexsort((np.arange(len(known)), keys_))
        self.keys, self.low = keys_, low


def _send_stretches(width: int, parts: int):
    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _table([])
        shared = Shared(left, _blob(right.column("keys")), width)
        keys, low = shared.keys[shared.order], shared.low[shared.order]
        rows = []
        for n, s in _parts_of(keys, parts):
            some = [shared.stretches[i] for i in shared.order[s].tolist()]
            sizes = np.array([len(x) for x in some], np.uint8)  # below 2 * width
            rows.append((
                key[0].as_py(), n, _packed(keys[s]), low[s].tobytes(), sizes.tobytes(),
                pa.compress(b"".join(some), codec="zstd", asbytes=True),
            ))
        return _table(rows)

    return run


def repeats(stretches: list[bytes], low: np.ndarray, width: int) -> np.ndarray:
    """For each stretch a mask (bit k: its k-th window) of what a smaller document has.

    ``low`` names each stretch's document. The windows are found by the suffix array of all
    stretches, each followed by bytes of its own.
    """
    masks = np.zeros(len(stretches), np.int64)
    if not stretches:
        return masks
    sizes = np.array([len(s) for s in stretches])
    text = np.frombuffer((b"\x00" * SEPARATE).join([*stretches, b""]), np.uint8)
    begins = np.concatenate(([0], np.cumsum(sizes + SEPARATE)[:-1]))
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + SEPARATE)
    edges = np.zeros(len(text) + 1, np.int8)
    edges[begins] = 1
    edges[begins + sizes - width + 1] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    words = _words(text, width)
    order = two_stage_order(text, width, inside, words)
    order = order[inside[order]]  # windows that end within their stretch
    owner = owner[order]
    place = order - begins[owner]
    first = ~repeated_with(words, order, width)
    group = np.cumsum(first) - 1
    if not len(group):
        return masks
    least = np.minimum.reduceat(low[owner], np.flatnonzero(first))
    gone = least[group] < low[owner]
    np.bitwise_or.at(masks, owner[gone], np.int64(1) << place[gone])
    return masks


def _find_repeats(width: int):
    def run(key, table):
        """Suffix-sort the distinct stretches of a part and answer every chunk."""
        chunks, stretches, counts, low = table.column("chunk").to_pylist(), [], [], []
        lists = zip(
            _blob(table.column("ids")), _blob(table.column("sizes")),
            table.column("texts").to_pylist(), strict=True,
        )
        for ids, sizes, texts in lists:
            bounds = [0, *np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64).tolist()]
            texts = pa.decompress(texts, bounds[-1], codec="zstd", asbytes=True)
            stretches += [texts[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            counts.append(len(bounds) - 1)
            low.append(np.frombuffer(ids, np.int64))
        low = np.concatenate(low) if low else np.zeros(0, np.int64)
        known: dict[bytes, int] = {}
        same = np.array([known.setdefault(s, len(known)) for s in stretches], np.int64)
        least = np.full(len(known), LAST, np.int64)
        np.minimum.at(least, same, low)
        masks = repeats(list(known), least, width)[same]
        # A stretch that a smaller document has as a whole repeats in all its windows.
        whole = least[same] < low
        sizes = np.array([len(s) for s in stretches], np.int64)
        masks[whole] = (np.int64(1) << (sizes[whole] - width + 1)) - 1
        rows, start = [], 0
        for chunk, count, keys in zip(chunks, counts, table.column("keys").to_pylist(), strict=True):
            own = masks[start : start + count].astype("<u4").tobytes()
            rows.append((chunk, key[0].as_py(), keys, own, None, None))
            start += count
        return _table(rows)

    return run


SPANS = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("n_spans", pa.int64()), ("kept", pa.binary()), ("starts", pa.list_(pa.int64())),
    ("ends", pa.list_(pa.int64())),
])
SPANS_DDL = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, "
    "starts array<bigint>, ends array<bigint>"
)


def whole_characters(data: bytes, starts: list[int], ends: list[int]):
    """Spans of UTF-8 bytes narrowed so that they cut no character."""
    inside = lambda n: n < len(data) and data[n] & 0xC0 == 0x80
    out = []
    for i, j in zip(starts, ends, strict=True):
        while inside(i):
            i += 1
        while inside(j):
            j -= 1
        if i < j:
            out.append((i, j))
    return [i for i, _ in out], [j for _, j in out]


def _remove(width: int, parts: int, characters: bool, carried: list[str]):
    def run(key, left, right):
        """Drop the bytes of the marked windows of every document of a chunk."""
        if not left.num_rows:
            empty = pa.table([pa.array([], f.type) for f in SPANS], schema=SPANS)
            for name in carried:
                empty = empty.append_column(name, pa.array([], left.schema.field(name).type))
            return empty
        answers = dict(zip(right.column("part").to_pylist(), _blob(right.column("ids")), strict=True))
        shared = Shared(left, _blob(right.column("keys")), width)
        masks = np.zeros(len(shared.keys), np.int64)
        for n, s in _parts_of(shared.keys[shared.order], parts):
            masks[shared.order[s]] = np.frombuffer(answers[n], "<u4")
        mask = masks[shared.same]
        # In a chunk a stretch was sent for its smallest document; the others repeat it.
        later = shared.owner > shared.low[shared.same]
        count = shared.last - shared.first + 1
        mask = np.where(later, (np.int64(1) << count) - 1, mask)
        windows, texts = [], []
        for bit in range(width - key_size(width) + 1):
            some = np.flatnonzero(mask >> bit & 1)
            windows.append(shared.first[some] + bit)
            texts.append(shared.number[some])
        windows, texts = np.concatenate(windows), np.concatenate(texts)
        order = np.lexsort((windows, texts))
        windows, texts = windows[order], texts[order]
        bounds = np.searchsorted(texts, np.arange(len(shared.texts) + 1))
        rows = []
        for n, data in enumerate(shared.texts):
            at = windows[bounds[n] : bounds[n + 1]]
            starts, ends = [], []
            if len(at):
                breaks = np.flatnonzero(at[1:] > at[:-1] + width)
                starts = at[np.append(0, breaks + 1)].tolist()
                ends = (at[np.append(breaks, len(at) - 1)] + width).tolist()
            if characters:
                starts, ends = whole_characters(data, starts, ends)
            kept, last = [], 0
            for i, j in zip(starts, ends, strict=True):
                kept.append(data[last:i])
                last = j
            kept.append(data[last:])
            rest = b"".join(kept)
            rows.append((
                shared.ids[n], len(data), len(data) - len(rest), len(starts), rest, starts, ends,
            ))
        columns = map(list, zip(*rows, strict=True))
        out = pa.table([pa.array(c, f.type) for c, f in zip(columns, SPANS, strict=True)], schema=SPANS)
        for name in carried:
            out = out.append_column(name, left.column(name).take(pa.array(shared.rows)))
        return out

    return run


def deduplicate(
    docs: DataFrame,
    width: int = WIDTH,
    characters: bool = False,
    carry: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with its removed spans and the ``kept`` bytes.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, or with ``carry``
    returned in a struct ``carried``. With ``characters`` a character goes only if all its
    bytes do. Gives ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``, and ``starts`` and ``ends`` of the
    maximal removed runs in the UTF-8 bytes of the text. Null is an empty text. A null id
    counts as after all others. Rows with the same id don't take bytes from each other, so
    repeated rows stay as they are. An empty table gives no rows.
    """
    if not 8 <= width <= 62:  # the windows of an anchor fit in a mask of 32 bits
        raise ValueError("width must be from 8 to 62 bytes")
    size = common.text_bytes(docs)
    chunks, parts = common.chunks_for(size, PER_CHUNK), common.chunks_for(size, PER_PART)
    chunk = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(chunks)).alias("chunk")
    others = [c for c in docs.columns if c not in ("doc_id", "text")] if carry else []
    names = [f"c{n}" for n in range(len(others))]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(others, names, strict=True)]
    rows = docs.select(chunk, "doc_id", "text", *columns)
    kinds = dict(rows.dtypes)
    schema = ", ".join([SPANS_DDL, *(f"{n} {kinds[n]}" for n in names)])
    # One query, so that its three readers of the texts share one exchange of them.
    by_chunk = rows.groupBy("chunk")
    keys = by_chunk.applyInArrow(_send_keys(width, parts), PART_DDL)
    shared = keys.groupBy("part").applyInArrow(_shared_keys, PART_DDL)
    sent = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(
        _send_stretches(width, parts), PART_DDL
    )
    masks = sent.groupBy("part").applyInArrow(_find_repeats(width), PART_DDL)
    found = by_chunk.cogroup(masks.groupBy("chunk")).applyInArrow(
        _remove(width, parts, characters, names), schema
    )
    if not carry:
        return found
    back = F.struct(*[F.col(n).alias(c) for c, n in zip(others, names, strict=True)]) if others else F.lit(None)
    return found.withColumn("carried", back).drop(*names)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed of every document, and the digest of the rest."""
    docs = common.table(spark, sf_dir, "documents")
    found = deduplicate(docs)
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
