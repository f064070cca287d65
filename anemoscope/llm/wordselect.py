"""Fill-in-the-middle examples, cut at code points found by select on machine words.

The UTF-8 bytes of many texts are read as one row of 64-bit words. In every word the bytes
that end a code point are marked by shifts and masks, ``bitwise_count`` gives the marks of a
word and a running sum those up to it. Where the k-th code point of a text ends is a search
in the sums, then a select inside one word, for all texts of a batch at once.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

#: Texts of a batch are cut into pieces of about this size, one text at least.
PIECE_BYTES = 8_000_000
ONES = np.uint64(0x0101010101010101)
HIGHS = np.uint64(0x8080808080808080)
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rates:
    """How texts are transformed, and the marks put into them."""

    seed: str = "1:"
    transformed: int = 90  # of 100 texts; the others stay plain
    suffix_first: int = 20  # of 100 transformed texts
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Units:
    """Where code points end in a run of UTF-8 bytes."""

    def __init__(self, data: bytes | np.ndarray):
        found = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        self.size = len(found)
        padded = np.zeros((self.size // 8 + 2) * 8, np.uint8)
        padded[: self.size] = found
        words = padded.view("<u8")
        # A byte 10xxxxxx goes on with a unit; all others, and the zero after the end, start one.
        starts = ~((words >> np.uint64(7)) & ~(words >> np.uint64(6))) & ONES
        ends = (starts[:-1] >> np.uint64(8)) | (starts[1:] << np.uint64(56))
        last = self.size // 8  # the word in which the bytes end
        ends[last] &= (np.uint64(1) << np.uint64(8 * (self.size % 8))) - np.uint64(1)
        ends[last + 1 :] = 0
        self.ends = ends
        self.upto = np.cumsum(np.bitwise_count(ends), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Units that end before each byte offset."""
        word, rest = np.divmod(np.asarray(at, np.int64), 8)
        before = (np.uint64(1) << (np.uint64(8) * rest.astype(np.uint64))) - np.uint64(1)
        inside = np.bitwise_count(self.ends[word] & before).astype(np.int64)
        return self.upto[word] - np.bitwise_count(self.ends[word]) + inside

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte offset just after the k-th unit, counted from 1; 0 for none."""
        k = np.asarray(k, np.int64)
        word = np.searchsorted(self.upto, k)
        ends = self.ends[word]
        wanted = (k - self.upto[word] + np.bitwise_count(ends)).astype(np.uint64)
        # Byte i of the product counts the marks up to it; its high bit then tells count >= wanted.
        counts = ends * ONES
        reached = ((counts | HIGHS) - wanted * ONES) & HIGHS
        place = 8 - np.bitwise_count(reached).astype(np.int64)
        return np.where(k > 0, 8 * word + place + 1, 0)


def _pieces(texts: pa.Array):
    """Slices of a string array, with few bytes in each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + PIECE_BYTES, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end, offsets[start : end + 1].astype(np.int64)
        start = end


def _cut(rates: Rates):
    """Adds form, units, cuts and the transformed text to rows of (doc_id, text, h1 to h4)."""
    marks = [m.encode() for m in rates.marks]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            h1, h2, h3, h4 = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(2, 6))
            for start, end, offsets in _pieces(texts):
                base = int(offsets[0])
                data = memoryview(texts.buffers()[2] or b"")[base : int(offsets[-1])]
                offsets = offsets - base
                units = Units(np.frombuffer(data, np.uint8))
                before = units.rank(offsets)
                n = np.diff(before)
                one, two = h1[start:end] % (n + 1), h2[start:end] % (n + 1)
                low, high = np.minimum(one, two), np.maximum(one, two)
                # A cut after no unit of a text is where the text begins.
                first = np.where(low > 0, units.select(before[:-1] + low), offsets[:-1])
                second = np.where(high > 0, units.select(before[:-1] + high), offsets[:-1])
                plain = (n == 0) | (h3[start:end] % 100 >= rates.transformed)
                forms, outputs = [], []
                for i, (a, b, c, d, stays, other) in enumerate(zip(
                    offsets[:-1].tolist(), first.tolist(), second.tolist(), offsets[1:].tolist(),
                    plain.tolist(), (h4[start:end] % 100 < rates.suffix_first).tolist(), strict=True,
                )):
                    text = bytes(data[a:d])
                    if stays or any(m in text for m in marks):
                        forms.append(PLAIN)
                        outputs.append(text)
                        plain[i] = True
                        continue
                    prefix, middle, suffix = bytes(data[a:b]), bytes(data[b:c]), bytes(data[c:d])
                    forms.append(SPM if other else PSM)
                    parts = (marks[0], prefix, marks[1], suffix, marks[2], middle)
                    if other:
                        parts = (marks[1], suffix, marks[0], prefix, marks[2], middle)
                    outputs.append(b"".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start), pa.array(n, pa.int64()),
                        pa.array(forms, pa.string()), pa.array(low, pa.int64(), mask=plain),
                        pa.array(high - low, pa.int64(), mask=plain),
                        pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def transform(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """Every row of ``docs`` as a fill-in-the-middle example.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever their names.
    Gives ``doc_id``, ``n`` (code points), ``form`` (``plain``, ``psm`` or ``spm``),
    ``prefix_chars`` and ``middle_chars`` (null if plain) and ``output``, the example. Cuts
    and form follow from a hash of the id alone, so repeated rows come out alike; a null id
    counts as empty text. A null or empty text gives a plain, empty example; a text that
    holds one of the marks stays plain. An empty table gives no rows.
    """
    digest = F.sha2(
        F.concat(F.lit(rates.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256
    )
    numbers = [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}")
        for k in range(4)
    ]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *numbers)
    return rows.mapInArrow(
        _cut(rates),
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint,"
        " output string",
    )


def restored(output: Column, form: Column, rates: Rates = Rates()) -> Column:
    """The text that an example was made from.

    The text holds no mark, so that the first one of each kind is the one put in.
    """
    after = F.substr(output, F.lit(len(rates.prefix) + 1))
    other = F.substr(output, F.lit(len(rates.suffix) + 1))
    last = F.substring_index(output, rates.middle, -1)
    prefix = F.substring_index(after, rates.suffix, 1)
    suffix = F.substring_index(F.substring_index(after, rates.middle, 1), rates.suffix, -1)
    spm_suffix = F.substring_index(other, rates.prefix, 1)
    spm_prefix = F.substring_index(F.substring_index(other, rates.middle, 1), rates.prefix, -1)
    return (
        F.when(form == PSM, F.concat(prefix, last, suffix))
        .when(form == SPM, F.concat(spm_prefix, last, spm_suffix))
        .otherwise(output)
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of the example of every document and of its restored text."""
    found = transform(common.table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )
