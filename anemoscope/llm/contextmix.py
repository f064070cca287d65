"""Language-model scoring by logistic mixing of context bit predictors.

A text is the sequence of its words, each ended by a blank, and one end. Every byte is
eight binary decisions. Predictors look at different contexts (the last one to four bytes,
and the word so far); every context has its own counts of bytes, in a table parted by the
hash of the context. Their predictions, as log odds, are added with weights that a gate
chooses by how often the context was seen; the weights are learned from all training texts,
and so is a last table, indexed by the decision and the mixed odds, that refines the result.

Contexts don't reach beyond a word, so a word has one probability wherever it stands.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

#: Order 1 to 4 and the word so far; slots of each, as powers of two, in a ``Model``.
SLOT_BITS = (16, 18, 19, 20, 21)
BLOCK = 1 << 14
#: Seen so many times: the gate's classes are powers of two. The word so far opens one of
#: three further gates for all predictors: never seen, seldom, or from this often on.
GATES, OFTEN = 14, 4
RATE, BATCH, EPOCHS = 0.05, 2_048, 2
REFINED, REFINE_RATE = 32, 0.02
END_OF_WORD, END_OF_TEXT = b" ", b"\n"  # no word holds either
#: UTF-8 bytes of documents to a chunk and to a part of the vocabulary.
PER_CHUNK, PER_PART = 12_000_000, 6_000_000
WORDS_TOGETHER = 300_000


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, without the end."""
    return text.encode().lower().split() if text else []


# --- Contexts ----------------------------------------------------------------------------


def positions(tokens: list[bytes], at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte of the tokens its token and its value, and rows of context hashes.

    The hashes are those of all bytes, or of the bytes ``at`` some places.
    """
    data = np.frombuffer(b"".join(tokens), np.uint8)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    token = np.repeat(np.arange(len(tokens)), sizes)
    at = np.arange(len(data)) if at is None else at
    place = (np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[at]
    value = data.astype(np.uint64)
    contexts = np.zeros((len(SLOT_BITS), len(at)), np.uint64)
    for back in range(1, len(SLOT_BITS)):
        before = value[np.maximum(at - back, 0)] + np.uint64(1)
        before[place < back] = 0
        for order in range(back, len(SLOT_BITS)):  # order n looks at the last n bytes
            contexts[order - 1] = contexts[order - 1] * np.uint64(0x9E3779B97F4A7C15) + before
    # The word so far: a polynomial in its bytes, taken from running sums of the whole.
    whole = np.zeros(len(data), np.uint64)
    by_size = np.argsort(-sizes, kind="stable")
    begins, longer = (np.cumsum(sizes) - sizes)[by_size], np.bincount(sizes)[::-1].cumsum()[::-1]
    for step in range(1, len(longer) - 1):
        here = begins[: longer[step + 1]] + step
        found = (whole[here - 1] + value[here - 1] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        whole[here] = found ^ (found >> np.uint64(32))
    contexts[-1] = whole[at]
    for order in range(len(SLOT_BITS)):
        contexts[order] = common.mixed(contexts[order] + np.uint64(order))
    return token, data, contexts


FIRST_SLOT = np.concatenate(([0], np.cumsum([1 << b for b in SLOT_BITS])))
SLOTS = int(FIRST_SLOT[-1])


def slots(contexts: np.ndarray, order: int, node: np.ndarray) -> np.ndarray:
    """Slot of a decision (the node of the tree of a byte's bits) in each context."""
    bits = np.uint32(SLOT_BITS[order])
    low = contexts[order].astype(np.uint32)
    found = (low ^ (node * np.uint32(0x9E3779B1))) * np.uint32(0x85EBCA6B)
    return (found >> np.uint32(32 - bits)).astype(np.int64) + FIRST_SLOT[order]


def decisions(data: np.ndarray):
    """The node and the bit of each of the eight decisions about every byte."""
    for step in range(8):
        above = (data.astype(np.uint32) >> np.uint32(8 - step)) if step else np.uint32(0)
        node = np.full(len(data), 1 << step, np.uint32) | above
        yield node, (data >> np.uint8(7 - step)) & 1


# --- Training ------------------------------------------------------------------------------


def count(tokens: list[bytes], times: np.ndarray, seen: np.ndarray, ones: np.ndarray) -> None:
    """Add tokens, each so many times, to the counts of every slot."""
    for start in range(0, len(tokens), 20_000):
        part = tokens[start : start + 20_000]
        token, data, contexts = positions(part)
        weight = times[start : start + 20_000][token]
        for node, bit in decisions(data):
            for order in range(len(SLOT_BITS)):
                at = slots(contexts, order, node) - FIRST_SLOT[order]
                span = slice(FIRST_SLOT[order], FIRST_SLOT[order + 1])
                size = 1 << SLOT_BITS[order]
                seen[span] += np.bincount(at, weight, size).astype(seen.dtype)
                ones[span] += np.bincount(at[bit > 0], weight[bit > 0], size).astype(ones.dtype)


@dataclass
class Model:
    """What each slot adds to the log odds, and the table that refines their sum.

    Its size doesn't depend on the corpus: ``SLOTS`` numbers and a small table.
    """

    odds: np.ndarray
    word_gate: np.ndarray
    refine: np.ndarray

    def log10(self, tokens: list[bytes]) -> np.ndarray:
        """log10 of the probability of each token, by its bytes."""
        out = np.zeros(len(tokens))
        for start in range(0, len(tokens), 4_000):
            part = tokens[start : start + 4_000]
            token, data, contexts = positions(part)
            bits = np.zeros(len(data))
            for node, bit in decisions(data):
                word = slots(contexts, len(SLOT_BITS) - 1, node)
                gate = self.word_gate[word - FIRST_SLOT[-2]].astype(np.int64) * SLOTS
                total = self.odds[gate + word].astype(np.float32)
                for order in range(len(SLOT_BITS) - 1):
                    total += self.odds[gate + slots(contexts, order, node)]
                total = (total + self.refine[node, refined_class(total)]) / 2
                bits -= np.logaddexp(0, np.where(bit > 0, -total, total))
            out[start : start + 4_000] = np.bincount(token, bits, len(part)) / math.log(10)
        return out


def refined_class(odds: np.ndarray) -> np.ndarray:
    return np.clip((odds + 8) * (REFINED / 16), 0, REFINED - 1).astype(np.int64)


def slot_odds(seen: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a one in each slot, and its gate: how often it was seen."""
    odds = np.log((ones + 0.3) / (seen - ones + 0.3))
    gate = np.minimum(np.ceil(np.log2(seen + 1)), GATES - 1).astype(np.int64)
    return np.where(seen > 0, odds, 0.0), gate


def fit_mixer(seen: np.ndarray, ones: np.ndarray, texts: list[list[bytes]]) -> Model:
    """Learn gated weights and the refining table online from some training texts.

    Each occurrence is predicted from the counts without itself.
    """
    orders = len(SLOT_BITS)
    weights = np.full((orders, GATES, 3), 0.3)
    refine = np.tile((np.arange(REFINED) + 0.5) * 16 / REFINED - 8, (256, 1))
    for _ in range(EPOCHS):
        for words in texts:
            tokens = [w + END_OF_WORD for w in words] + [END_OF_TEXT]
            for start in range(0, len(tokens), BATCH // 8):
                _, data, contexts = positions(tokens[start : start + BATCH // 8])
                for node, bit in decisions(data):
                    inputs = np.zeros((orders, len(data)))
                    gates = np.zeros((orders, len(data)), np.int64)
                    for order in range(orders):
                        at = slots(contexts, order, node)
                        left = np.maximum(seen[at] - 1, 0)  # in the end of the word so far
                        inputs[order], gates[order] = slot_odds(
                            left, np.maximum(ones[at] - bit, 0)
                        )
                    which = np.arange(orders)[:, None], gates, word_class(left)[None, :]
                    total = (weights[which] * inputs).sum(0)
                    error = bit - 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                    slope, times = np.zeros_like(weights), np.zeros_like(weights)
                    np.add.at(slope, which, inputs * error)
                    np.add.at(times, which, 1.0)
                    weights += RATE * slope / (times + 4.0)
                    cell = node.astype(np.int64), refined_class(total)
                    wrong = bit - 1 / (1 + np.exp(-refine[cell]))
                    step, hits = np.zeros_like(refine), np.zeros_like(refine)
                    np.add.at(step, cell, wrong)
                    np.add.at(hits, cell, 1.0)
                    refine += REFINE_RATE * step / (hits + 1.0)
    added = np.zeros((3, SLOTS), np.float16)
    for order in range(orders):
        span = slice(FIRST_SLOT[order], FIRST_SLOT[order + 1])
        odds, gate = slot_odds(seen[span], ones[span])
        for k in range(3):
            added[k, span] = weights[order, gate, k] * odds
    word_gate = word_class(seen[FIRST_SLOT[-2] :]).astype(np.uint8)
    return Model(added.ravel(), word_gate, refine.astype(np.float32))


def word_class(seen: np.ndarray) -> np.ndarray:
    return (seen > 0).astype(np.int64) + (seen >= OFTEN)


# --- Counts of all contexts, kept in Spark tables ------------------------------------------

#: A decision table's rows: where a row goes, where it comes from, and packed arrays.
PACK = pa.schema([
    ("at", pa.int64()), ("origin", pa.int64()), ("kind", pa.int32()), ("first", pa.binary()),
    ("second", pa.binary()), ("third", pa.binary()), ("fourth", pa.binary()),
    ("known", pa.int64()), ("tokens", pa.int64()),
])
PACK_DDL = (
    "at bigint, origin bigint, kind int, first binary, second binary, third binary, "
    "fourth binary, known bigint, tokens bigint"
)
REPLY, KEPT = 0, 1
ORDERS = len(SLOT_BITS)
BETWEEN = b"\t"  # no word holds it


def _packed(rows: list[tuple]) -> pa.Table:
    filled = [r + (None,) * (len(PACK) - len(r)) for r in rows]
    columns = list(map(list, zip(*filled, strict=True))) if rows else [[] for _ in PACK]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, PACK, strict=True)], schema=PACK)


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """An array compressed: its differences if it rises, first bytes of all numbers together."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return pack_text(planes)


def unpack(blob: bytes, kind: str = "<i8", rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(unpack_text(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


def pack_text(text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + (pa.compress(text, "zstd", asbytes=True) if text else b"")


def unpack_text(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], size, "zstd", asbytes=True) if size else b""


def pack_tokens(tokens: list[bytes]) -> bytes:
    return pack_text(BETWEEN.join(tokens))


def unpack_tokens(blob: bytes) -> list[bytes]:
    return unpack_text(blob).split(BETWEEN)


def _arrays(table: pa.Table, name: str, kind: str = "<i8", rising: bool = False):
    return [unpack(b, kind, rising) for b in table.column(name).to_pylist()]


def _entries(table: pa.Table) -> list[np.ndarray]:
    return _arrays(table, "first", "<u8", rising=True)


def spelled(words) -> list[bytes]:
    """Words as they are predicted, each with its end."""
    return [w if w == END_OF_TEXT else w + END_OF_WORD for w in words]


def part_of(tokens: list[bytes], parts: int) -> np.ndarray:
    import xxhash

    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    return (hashes >> np.uint64(40)).astype(np.int64) * parts >> 24


def by_part(part: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    return [(n, order[ends[n] : ends[n + 1]]) for n in range(parts) if ends[n] < ends[n + 1]]


def cuts(entries: np.ndarray, parts: int) -> list[tuple[int, slice]]:
    """Slices of sorted entries by the part that keeps their contexts."""
    part = (entries >> np.uint64(40)).astype(np.int64) * parts >> 24
    ends = np.searchsorted(part, np.arange(parts + 1))
    return [(n, slice(ends[n], ends[n + 1])) for n in range(parts) if ends[n] < ends[n + 1]]


def nodes_of(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte of the sorted distinct tokens its token and its node of their tree.

    Tokens with the same beginning share the nodes of it. Then, for every order and node,
    the entry that counts its byte in its context: 53 bits of the context's hash, three of
    the order, so that no order meets another, and eight of the byte.
    """
    data = np.frombuffer(b"".join(tokens), np.uint8)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    token = np.repeat(np.arange(len(tokens)), sizes)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - begins[token]
    before = np.maximum(token - 1, 0)
    other = np.minimum(begins[before] + place, len(data) - 1)
    same = (token > 0) & (place < sizes[before]) & (data[other] == data)
    if len(data):  # up to the first byte that is not that of the token before
        same = place < np.minimum.reduceat(np.where(same, len(data), place), begins)[token]
    small = np.uint16 if len(sizes) and sizes.max() < 1 << 16 else np.int64
    order = np.argsort(place.astype(small), kind="stable")
    fresh = ~same[order]
    node = np.empty(len(data), np.int64)
    node[order] = np.cumsum(fresh) - 1
    at = order[fresh]
    contexts = positions(tokens, at)[2]
    entries = contexts >> np.uint64(11) << np.uint64(11)
    entries |= (np.arange(ORDERS, dtype=np.uint64) << np.uint64(8))[:, None]
    return token, node, entries | data[at].astype(np.uint64)


def summed(entries: list[np.ndarray], totals: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct entries in order and the sums of their totals."""
    if not entries:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined, counts = np.concatenate(entries), np.concatenate(totals).astype(np.int64)
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(joined)), bool), joined[1:] != joined[:-1])))
    return joined[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def places_of(needs: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Places of the needed entries among sorted ones, looked up in their order."""
    flat = needs.ravel()
    order = np.argsort(flat)
    at = np.empty(len(flat), np.int64)
    at[order] = np.searchsorted(entries, flat[order])
    return at.reshape(needs.shape)


def of_contexts(entries: np.ndarray, contexts: list[np.ndarray]) -> list[np.ndarray]:
    """Places of all entries of the asked contexts, for each of the lists."""
    own = entries >> np.uint64(8)
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(own)), bool), own[1:] != own[:-1])))
    known, sizes = own[starts], np.diff(np.append(starts, len(own)))
    out = []
    for asked in contexts:
        hit = np.searchsorted(known, asked)
        inside = hit < len(known)
        hit = hit[inside][known[hit[inside]] == asked[inside]]
        long = sizes[hit]
        out.append(np.repeat(starts[hit] - (np.cumsum(long) - long), long) + np.arange(long.sum()))
    return out


def runs(entries: np.ndarray, totals: np.ndarray, bits: int) -> np.ndarray:
    """For each entry how often its context met the first ``bits`` bits of its byte."""
    key = entries >> np.uint64(8 - bits)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return np.repeat(np.add.reduceat(totals, starts), np.diff(np.append(starts, len(key))))


#: Odds and gates of counts below this are looked up.
FEW = 256
_few: list[tuple[np.ndarray, np.ndarray]] = []


def odds_and_gates(seen: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``slot_odds``, with three cells to a gate."""
    if not _few:
        whole, part = np.divmod(np.arange(FEW * FEW), FEW)
        odds, gate = slot_odds(whole, np.minimum(part, whole))
        _few.append((odds.astype(np.float32), (gate * 3).astype(np.int16)))
    at = np.where(seen < FEW, np.maximum(seen, 0) * FEW + np.maximum(own, 0), 0)
    odds, gate = _few[0][0][at], _few[0][1][at]
    many = np.flatnonzero(seen >= FEW)
    if len(many):
        odds[many], large = slot_odds(seen[many], own[many])
        gate[many] = large * 3
    return odds, gate


def steps(entries: np.ndarray, totals: np.ndarray, at: np.ndarray, without: int):
    """The eight decisions of every node: inputs, gates, and the refining table's row.

    Inputs are the log odds of the bit that the node has. ``without`` is 1 if each
    occurrence is to be predicted from the counts without itself.
    """
    value = entries[at[-1]] & np.uint64(255)
    whole = runs(entries, totals, 0)
    for step in range(8):
        part = runs(entries, totals, step + 1)
        odds, gate = odds_and_gates(whole - without, part - without)
        kind = word_class((whole - without)[at[-1]])
        row = (1 << step) | (value >> np.uint64(8 - step)).astype(np.int64)
        bit = (value >> np.uint64(7 - step)) & np.uint64(1) > 0
        yield odds[at], gate[at], kind, row, bit
        whole = part


def mixed_odds(weights: np.ndarray, odds: np.ndarray, gate: np.ndarray, kind: np.ndarray):
    total = np.zeros(odds.shape[1], np.float64)
    for order in range(ORDERS):
        total += weights[order].ravel()[gate[order] + kind] * odds[order]
    return np.clip(total, -30, 30)


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]):
        words: Counter = Counter()

        def rows():
            tokens, times = spelled(words), np.fromiter(words.values(), np.int64, len(words))
            words.clear()
            for n, own in by_part(part_of(tokens, parts), parts):
                text = pack_tokens([tokens[i] for i in own.tolist()])
                yield from _packed([(n, 0, 0, text, pack(times[own]))]).to_batches()

        for (texts,) in common.rows_of(batches, "text", at_most=500):
            for text in texts:
                words.update(tokens_of(text))
                words[END_OF_TEXT] += 1
            if len(words) > WORDS_TOGETHER:
                yield from rows()
        if words:
            yield from rows()

    return run


def _unite_words(key, table):
    """The distinct tokens of a part in order, and how often all training texts have them."""
    words: Counter = Counter()
    for text, times in zip(table.column("first").to_pylist(), _arrays(table, "second"), strict=True):
        for word, n in zip(unpack_tokens(text), times.tolist(), strict=True):
            words[word] += n
    tokens = sorted(words)
    times = np.array([words[t] for t in tokens], np.int64)
    return _packed([(key[0].as_py(), 0, 0, pack_tokens(tokens), pack(times))])


def counted(tokens: list[bytes], times: np.ndarray):
    """Nodes of sorted tokens: their entries by order and how often they occur."""
    token, node, needs = nodes_of(tokens)
    return needs, np.bincount(node, times[token]).astype(np.int64)


def _send_entries(parts: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for rows in batches:
            for n in range(rows.num_rows):
                row = rows.slice(n, 1).to_pylist()[0]
                needs, times = counted(unpack_tokens(row["first"]), unpack(row["second"]))
                entries, totals = summed(list(needs), [times] * ORDERS)
                for q, own in cuts(entries, parts):
                    yield from _packed([
                        (q, row["at"], 0, pack(entries[own], rising=True), pack(totals[own]))
                    ]).to_batches()

    return run


def _total_entries(key, table):
    """Counts over all parts: a row that is kept, and to every part its contexts whole."""
    lists = _entries(table)
    entries, totals = summed(lists, _arrays(table, "second"))
    rows = [(key[0].as_py(), -1, KEPT, pack(entries, rising=True), pack(totals))]
    asked = [np.unique(own >> np.uint64(8)) for own in lists]
    origins = table.column("origin").to_pylist()
    for origin, own in zip(origins, of_contexts(entries, asked), strict=True):
        reply = pack(entries[own], rising=True), pack(totals[own])
        rows.append((origin, key[0].as_py(), REPLY, *reply))
    return _packed(rows)


def _answers(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return summed(_entries(table), _arrays(table, "second"))


def _prepare(key, left, right):
    """A part's nodes ready for the passes: counts, places among them, and occurrences."""
    row = left.to_pylist()[0]
    needs, times = counted(unpack_tokens(row["first"]), unpack(row["second"]))
    entries, totals = _answers(right)
    at = places_of(needs, entries).astype("<u4")
    blobs = pack(entries, rising=True), pack(totals), pack(at.ravel()), pack(times)
    return _packed([(key[0].as_py(), 0, 0, *blobs)])


# --- Weights from all training texts ---------------------------------------------------------

#: Newton passes over all training texts (with the curvature of the first), and the pull of a weight to where it starts.
PASSES, START, PULL = 3, 0.3, 1.0
#: Part of a step that is taken: the first curvature is flatter than those that follow.
STEP = 0.5
#: Occurrences that a cell of the refining table is taken to have had before the first.
REFINE_PULL = 4.0
CELLS = GATES * 3
PAIRS = [(a, b) for a in range(ORDERS) for b in range(a, ORDERS)]
SLICES = 16


def slopes(weights, entries, totals, at, times, curved: bool = False) -> np.ndarray:
    """The loss of a part's occurrences, its slope, and its curvature by pairs of cells."""
    loss, slope, times = 0.0, np.zeros((ORDERS, CELLS)), times.astype(np.float64)
    curve = np.zeros((len(PAIRS), GATES * CELLS))
    for odds, gate, kind, _, _ in steps(entries, totals, at, 1):
        total = mixed_odds(weights, odds, gate, kind)
        odds_against = np.exp(-total)
        wrong = odds_against / (1 + odds_against)
        loss += float(times @ np.log(1 + odds_against))
        bend = times * wrong * (1 - wrong) if curved else None
        wrong *= times
        for order in range(ORDERS):
            slope[order] += np.bincount(gate[order] + kind, wrong * odds[order], CELLS)
        if not curved:
            continue
        bent = [bend * odds[order] for order in range(ORDERS)]
        wide = [gate[order].astype(np.int64) * GATES + kind for order in range(ORDERS)]
        for n, (a, b) in enumerate(PAIRS):
            curve[n] += np.bincount(wide[a] + gate[b], bent[a] * odds[b], GATES * CELLS)
    return np.concatenate(([loss], slope.ravel(), curve.ravel() if curved else []))


def slopes_and_curve(*args) -> np.ndarray:
    return slopes(*args, curved=True)


def curvature(sums: np.ndarray) -> np.ndarray:
    curve = np.zeros((ORDERS, GATES, 3, ORDERS, GATES, 3))
    for (a, b), own in zip(PAIRS, sums[1 + ORDERS * CELLS :].reshape(len(PAIRS), -1), strict=True):
        own = own.reshape(GATES, GATES, 3)
        for k in range(3):
            curve[a, :, k, b, :, k] = own[:, :, k]
            curve[b, :, k, a, :, k] = own[:, :, k].T
    return curve.reshape(ORDERS * CELLS, -1) + PULL * np.eye(ORDERS * CELLS)


def refinements(weights, entries, totals, at, times) -> np.ndarray:
    """The loss, and by cells of the refining table how often a one and a zero came."""
    loss, cells, times = 0.0, np.zeros((2, 256 * REFINED)), times.astype(np.float64)
    for odds, gate, kind, row, bit in steps(entries, totals, at, 1):
        total = mixed_odds(weights, odds, gate, kind)
        loss += float(times @ np.log(1 + np.exp(-total)))
        cell = row * REFINED + refined_class(np.where(bit, total, -total))
        for n, own in enumerate((bit, ~bit)):
            cells[n] += np.bincount(cell[own], times[own], 256 * REFINED)
    return np.concatenate(([loss], cells.ravel()))


def refining_table(sums: np.ndarray) -> np.ndarray:
    ones, zeros = sums[1:].reshape(2, 256, REFINED)
    chance = 1 / (1 + np.exp(-((np.arange(REFINED) + 0.5) * 16 / REFINED - 8)))
    return np.log((ones + REFINE_PULL * chance) / (zeros + REFINE_PULL * (1 - chance)))


def penalised(sums: np.ndarray, weights: np.ndarray) -> float:
    return sums[0] + PULL / 2 * float(((weights - START) ** 2).sum())


def _sum_over(prepared: DataFrame, what, weights: np.ndarray) -> np.ndarray | None:
    """Sums over all parts, added in one order whatever the partitions; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]):
        for rows in batches:
            for n in range(rows.num_rows):
                row = rows.slice(n, 1).to_pylist()[0]
                entries, totals = unpack(row["first"], "<u8", rising=True), unpack(row["second"])
                at, times = unpack(row["third"], "<u4").reshape(ORDERS, -1), unpack(row["fourth"])
                found = what(weights, entries, totals, at, times)
                yield from _packed([
                    (k, row["at"], 0, pack(piece))
                    for k, piece in enumerate(np.array_split(found, SLICES))
                ]).to_batches()

    def add(key, table):
        pieces = zip(table.column("origin").to_pylist(), _arrays(table, "first", "<f8"), strict=True)
        pieces = sorted(pieces, key=lambda piece: piece[0])
        return _packed([(key[0].as_py(), 0, 0, pack(np.sum([p for _, p in pieces], axis=0)))])

    sums = prepared.mapInArrow(run, PACK_DDL).groupBy("at").applyInArrow(add, PACK_DDL)
    found = sorted((r["at"], bytes(r["first"])) for r in sums.select("at", "first").collect())
    return np.concatenate([unpack(b, "<f8") for _, b in found]) if found else None


def fit(sums_of) -> tuple[np.ndarray, np.ndarray]:
    """Weights and refining table; ``sums_of`` adds one of the sums above over all texts."""
    weights = np.full((ORDERS, GATES, 3), START)
    best, least = weights, math.inf
    for step in range(PASSES):
        sums = sums_of(slopes if step else slopes_and_curve, weights)
        if sums is None:
            return weights, refining_table(np.zeros(1 + 2 * 256 * REFINED))
        if not step:
            curve = curvature(sums)
        if penalised(sums, weights) <= least:
            best, least = weights, penalised(sums, weights)
            slope = sums[1 : 1 + ORDERS * CELLS] - PULL * (weights.ravel() - START)
            weights = weights + STEP * np.linalg.solve(curve, slope).reshape(weights.shape)
        else:
            weights = (weights + best) / 2
    sums = sums_of(refinements, weights)
    if penalised(sums, weights) > least:
        weights = best
        sums = sums_of(refinements, weights)
    return weights, refining_table(sums)


def log10_of(tokens, entries, totals, weights, refine) -> np.ndarray:
    """log10 of the probability of each of the sorted distinct tokens."""
    token, node, needs = nodes_of(tokens)
    needed, at = np.unique(needs, return_inverse=True)
    entries, totals = summed([entries, needed], [totals, np.zeros(len(needed), np.int64)])
    at = np.searchsorted(entries, needed)[at].reshape(needs.shape)
    bits = np.zeros(needs.shape[1])
    for odds, gate, kind, row, bit in steps(entries, totals, at, 0):
        total = mixed_odds(weights, odds, gate, kind)
        refined = refine[row, refined_class(np.where(bit, total, -total))]
        bits -= np.log(1 + np.exp(-(total + np.where(bit, refined, -refined)) / 2))
    return np.bincount(token, bits[node], len(tokens)) / math.log(10)


@dataclass
class Mixture:
    """Counts of all contexts as a staged table, by parts of their hashes, and the weights."""

    contexts: DataFrame
    parts: int
    weights: np.ndarray
    refine: np.ndarray


def learn(docs: DataFrame) -> Mixture:
    """Counts of every context, weights and refining table, all from all texts of ``docs``.

    ``docs`` needs ``text``. A null text is an empty one: it has an end. An occurrence of a
    token is predicted in the passes from the counts without itself, so all occurrences of a
    token are alike and the passes go over the distinct tokens with their numbers.
    """
    staging = common.Staging(docs.sparkSession)
    parts = common.chunks_for(common.text_bytes(docs), PER_PART)
    sent = docs.select("text").mapInArrow(_count_words(parts), PACK_DDL)
    words = staging.stage(sent.groupBy("at").applyInArrow(_unite_words, PACK_DDL), "words")
    asked = words.mapInArrow(_send_entries(parts), PACK_DDL)
    found = staging.stage(asked.groupBy("at").applyInArrow(_total_entries, PACK_DDL), "contexts")
    replies = found.where(F.col("kind") == REPLY).groupBy("at")
    prepared = words.groupBy("at").cogroup(replies).applyInArrow(_prepare, PACK_DDL)
    prepared = staging.stage(prepared, "prepared")
    weights, refine = fit(lambda what, weights: _sum_over(prepared, what, weights))
    return Mixture(found.where(F.col("kind") == KEPT), parts, weights, refine)


# --- Scoring -----------------------------------------------------------------------------------


class Vocabulary:
    """Distinct tokens of a chunk."""

    def __init__(self, table: pa.Table, parts: int):
        self.ids = table.column("doc_id").to_pylist()
        self.held_out = table.column("held_out").to_pylist()
        numbers: dict[bytes, int] = {END_OF_TEXT: 0}
        self.texts = []
        for text in table.column("text").to_pylist():
            words = tokens_of(text)
            own = [numbers.setdefault(w, len(numbers)) for w in words]
            own.append(0)
            self.texts.append(np.array(own))
        self.tokens = spelled(numbers)
        self.slices = by_part(part_of(self.tokens, parts), parts)


def _send_words(parts: int):
    def run(key, table):
        """Distinct tokens of a chunk and how often its training texts have them."""
        found = Vocabulary(table, parts)
        counts = np.zeros(len(found.tokens), np.int64)
        for own, held_out in zip(found.texts, found.held_out, strict=True):
            if not held_out:
                np.add.at(counts, own, 1)
        return _packed([
            (n, key[0].as_py(), 0, pack_tokens([found.tokens[i] for i in s.tolist()]),
             pack(counts[s]))
            for n, s in found.slices
        ])

    return run


def _united(table: pa.Table):
    """Sorted distinct tokens of a part's messages, their counts, and each message's places."""
    numbers: dict[bytes, int] = {}
    lists = [
        [numbers.setdefault(w, len(numbers)) for w in unpack_tokens(text)]
        for text in table.column("first").to_pylist()
    ]
    tokens = sorted(numbers)
    rank = np.empty(len(tokens), np.int64)
    rank[[numbers[t] for t in tokens]] = np.arange(len(tokens))
    lists = [rank[own] for own in lists]
    total = np.zeros(len(tokens), np.int64)
    for own, counts in zip(lists, _arrays(table, "second"), strict=True):
        total[own] += counts
    return tokens, total, lists


def _ask(parts: int):
    def run(key, table):
        """The contexts of a part's tokens, asked from where their counts are kept."""
        _, _, needs = nodes_of(_united(table)[0])
        asked = np.unique(needs >> np.uint64(8) << np.uint64(8))
        return _packed([
            (q, key[0].as_py(), 0, pack(asked[own] >> np.uint64(8), rising=True))
            for q, own in cuts(asked, parts)
        ])

    return run


def _reply(key, left, right):
    """Counts of the asked contexts; nothing of contexts that no training text has."""
    entries, totals = _answers(right)
    places = of_contexts(entries, _entries(left))
    return _packed([
        (origin, key[0].as_py(), REPLY, pack(entries[own], rising=True), pack(totals[own]))
        for origin, own in zip(left.column("origin").to_pylist(), places, strict=True)
    ])


def _score_words(weights: np.ndarray, refine: np.ndarray):
    def run(key, left, right):
        """Counts and scores of every chunk's tokens; the first row has the part's sums."""
        if not left.num_rows:
            return _packed([])
        tokens, total, lists = _united(left)
        scores = log10_of(tokens, *_answers(right), weights, refine)
        rows = []
        for chunk, own in zip(left.column("origin").to_pylist(), lists, strict=True):
            sums = (int((total > 0).sum()), int(total.sum())) if not rows else (0, 0)
            blobs = pack(total[own]), pack(scores[own].astype("<f4"))
            rows.append((chunk, key[0].as_py(), 0, *blobs, None, None, *sums))
        return _packed(rows)

    return run


SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64()), ("bits_per_byte", pa.float64()),
])
SCORES_DDL = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double, bits_per_byte double"
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(map(list, zip(*rows, strict=True))) if rows else [[] for _ in schema]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.table(arrays, schema=schema)


def _score(parts: int, distinct: int, tokens: int):
    def run(key, left, right):
        found = Vocabulary(left, parts)
        answers = dict(zip(
            right.column("origin").to_pylist(),
            zip(_arrays(right, "first"), _arrays(right, "second", "<f4"), strict=True),
            strict=True,
        ))
        counts, mixed = np.zeros(len(found.tokens), np.int64), np.zeros(len(found.tokens))
        for n, s in found.slices:
            counts[s], mixed[s] = answers[n]
        base = np.log10((counts + 0.1) / (tokens + 0.1 * (distinct + 1)))
        size = np.array(list(map(len, found.tokens)))
        rows = []
        for doc_id, held_out, own in zip(found.ids, found.held_out, found.texts, strict=True):
            total = float(mixed[own].sum())
            rows.append((
                doc_id, held_out, len(own), int((counts[own] > 0).sum()), tokens,
                float(base[own].sum()), total, -total / math.log10(2) / int(size[own].sum()),
            ))
        return _table(rows, SCORES)

    return run


def score(docs: DataFrame, model: Mixture, staging: common.Staging) -> DataFrame:
    """Scores of every row of ``docs``: ``doc_id``, ``text`` and boolean ``held_out``.

    ``base_score`` is the smoothed frequency of tokens in the texts that aren't held out,
    ``score`` the model's log10 probability of the tokens, ``bits_per_byte`` the same in bits
    over the bytes of words, blanks and end. Null and empty texts are an end alone. Repeated
    rows count as often as they occur. An empty table gives no rows.
    """
    size = common.text_bytes(docs)
    chunks, parts = common.chunks_for(size, PER_CHUNK), common.chunks_for(size, PER_PART)
    rows = docs.select(
        F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(chunks)).cast("long").alias("chunk"),
        "doc_id", "text", "held_out",
    )
    by_chunk = rows.groupBy("chunk")
    sent = staging.stage(by_chunk.applyInArrow(_send_words(parts), PACK_DDL), "sent")
    asked = sent.groupBy("at").applyInArrow(_ask(model.parts), PACK_DDL)
    replies = asked.groupBy("at").cogroup(model.contexts.groupBy("at"))
    replies = replies.applyInArrow(_reply, PACK_DDL)
    run = _score_words(model.weights, model.refine)
    totals = sent.groupBy("at").cogroup(replies.groupBy("at")).applyInArrow(run, PACK_DDL)
    totals = staging.stage(totals, "totals")
    sums = totals.agg(F.sum("known").alias("known"), F.sum("tokens").alias("tokens")).first()
    run = _score(parts, sums.known or 0, sums.tokens or 0)
    return by_chunk.cogroup(totals.groupBy("at")).applyInArrow(run, SCORES_DDL)


#: One in ten documents is held out.
FOLDS = 10


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by what nine of ten folds teach."""
    held_out = common.fold_of(F.col("doc_id"), FOLDS) == 0
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out)
    model = learn(docs.where(~F.col("held_out")))
    return score(docs, model, common.Staging(spark))
