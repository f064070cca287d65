"""Line dedup, the audit of filters and fill-in-middle examples, against plain loops."""

import hashlib
import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from anemoscope.llm import common, lineindex, postings, wordselect
from check_queries import connect, difference
from tests.llm.conftest import SF, odd_rows

BLANKS = " \t\n\v\f\r"


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_filter_audit", "op13_fill_in_middle"])
def test_query_matches_sql(spark, name):
    found = registry.queries()[name](spark, SF).toArrow()
    expected = connect(SF).sql(registry.oracle_sql()[name]).to_arrow_table()
    assert found.num_rows > 0
    assert difference(found, expected) is None


# --- Line dedup -------------------------------------------------------------------


def lines_left(rows, least_chars=40, least_documents=5):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda line: line.strip(BLANKS).translate(lower)
    value = lambda i: -1 << 70 if i is None else i
    holders = {}
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders.setdefault(k, []).append(value(i))
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key(x), value(i)) == value(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    draw = random.Random(8)
    wide = "Übergrößenträger 日本語 " * 3
    pool = [f"shared line number {n} that is long enough to be counted" for n in range(12)]
    pool += [wide, "x" * 39, "Y" * 40, "short", "", "é" * 39, "é" * 40]
    rows = []
    for i in range(60):
        lines = [draw.choice(pool) for _ in range(draw.randint(0, 9))]
        lines = [draw.choice(["", " \t", "\r"]) + draw.choice([x, x.upper() if x.isascii() else x]) + draw.choice(["", "\v "]) for x in lines]
        rows.append((i, "\n".join(lines)))
    return [*rows, (None, pool[0]), (None, "\n".join([pool[1]] * 3)), (70, None), (71, ""), rows[3]]


def test_line_dedup(spark, monkeypatch):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = docs.withColumns({n: F.lit(7) for n in ("chunk", "shard", "keys", "last", "kept", "n_lines")})
    for chunk_bytes, shard_bytes in ((4_000_000, 64_000_000), (500, 900)):
        monkeypatch.setattr(lineindex, "CHUNK_BYTES", chunk_bytes)
        monkeypatch.setattr(lineindex, "SHARD_BYTES", shard_bytes)
        found = sorted(map(tuple, lineindex.deduplicate(clash).collect()), key=str)
        assert found == lines_left(rows)
    found = lineindex.deduplicate(docs, lineindex.Rule(5, 2)).collect()
    assert sorted(map(tuple, found), key=str) == lines_left(rows, 5, 2)


def test_line_dedup_of_odd_rows(spark, odd, empty):
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = sorted(map(tuple, lineindex.deduplicate(odd, lineindex.Rule(2, 2)).collect()), key=str)
    assert found == lines_left(rows, 2, 2)
    assert lineindex.deduplicate(empty).count() == 0


def test_line_everywhere_is_one_entry_per_chunk(spark):
    text = "a line that all the documents of this table have in them"
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    found = lineindex.deduplicate(docs).groupBy("n_dropped").count().collect()
    assert dict(map(tuple, found)) == {0: 1, 1: 2_999}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash(n):
    keys = np.zeros(n, lineindex.PAIR)
    draw = np.random.default_rng(n)
    keys["hi"] = draw.integers(0, 1 << 60, n, np.uint64)
    keys["lo"] = np.arange(n)
    keys["hi"][: n // 2] = 5  # half of the keys differ in one word only
    found = lineindex.PerfectHash(keys)
    assert sorted(found.numbers(keys).tolist()) == list(range(n))
    assert 64 * len(found.words) <= 6 * n + 64 * 40


def test_index_rejects_foreign_lines():
    draw = np.random.default_rng(1)
    keys = np.zeros(20_000, lineindex.PAIR)
    keys["hi"], keys["lo"] = draw.integers(0, 1 << 63, (2, 20_000), np.uint64)
    own, foreign = keys[:10_000], keys[10_000:]
    counts = draw.integers(1, 9, 10_000)
    index = lineindex.LineIndex(own, counts, np.arange(10_000), 5)
    often, last = index.probe(own)
    assert (often == (counts >= 5)).all() and (last == np.flatnonzero(often)).all()
    assert index.probe(foreign)[0].sum() < 5
    assert index.counts.nbytes + index.prints.nbytes == 3 * 10_000


# --- Audit of filters -----------------------------------------------------------------


def test_gallop_and_merges():
    draw = random.Random(5)
    for size in (0, 1, 7, 5_000, 20_000):
        sets = [set(draw.sample(range(40_000), draw.randint(0, size))) for _ in range(4)]
        lists = [np.array(sorted(s), np.int64) for s in sets]
        assert postings.union(lists).tolist() == sorted(set().union(*sets))
        assert postings.difference(lists[0], lists[1:]).tolist() == sorted(
            sets[0] - sets[1] - sets[2] - sets[3]
        )
        assert postings.common_size(lists[0], lists[1]) == len(sets[0] & sets[1])
        for bound in (-1, 0, 17, 39_999):
            for start in {0, len(lists[0]) // 2, len(lists[0])}:
                expected = max(start, int(np.searchsorted(lists[0], bound, "right")))
                assert postings.gallop(lists[0], start, bound) == expected


def plain_audit(rows, labels):
    """Every order applied to every row, one filter after the other."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    judged = []
    for i, text, source in rows:
        t = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
        fails = set()
        fails |= {"A"} if len(words) < 50 else set()
        fails |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        fails |= {"D"} if set(t) & set("#$%&*|") else set()
        fails |= {"E"} if t in first and (i is None or i > first[t]) else set()
        judged.append((source or "", fails, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in judged}:
        mine = [r for r in judged if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                failing = sum(f in r[1] for r in mine)
                out[part, "".join(order), step] = [
                    f, len(left), len(gone), failing - len(gone),
                    sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row.append(shapley[row[0]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("range_rows, hot", [(65_536, 1_000), (3, 2)])
def test_audit(spark, odd, staging, monkeypatch, range_rows, hot):
    monkeypatch.setattr(postings, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(postings, "HOT_TEXTS", hot)
    monkeypatch.setattr(postings, "WINDOW", 2)
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (10, 1, 1), (12, 0, 1), (None, 1, 1), (99, 1, 1), (5, None, None)]
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("part", F.lit(1))
    more = spark.createDataFrame(
        [(30 + n, f"SOME Text {n % 3} #", "s1") for n in range(9)], "doc_id bigint, text string, source string"
    )
    docs = odd.unionByName(more, allowMissingColumns=True).withColumns(
        {n: F.lit(7) for n in ("part", "failed", "text_key", "rows", "first_id", "words", "good")}
    )
    found = postings.audit(docs, marked, staging).collect()
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    assert {tuple(r[:3]) for r in found} and len(found) == 600 * len({r[2] or "" for r in rows})
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in found}
    assert got == plain_audit(rows, labels)


def test_audit_without_rows(spark, odd, empty, staging):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert postings.audit(empty, labels, staging).count() == 0
    assert postings.audit(odd, labels, staging).agg(F.sum("good_lost")).first()[0] == 0


# --- Fill in the middle ----------------------------------------------------------------


def plain_example(i, text):
    t = text or ""
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, len(t), "plain", None, None, t
    prefix, middle, suffix = t[:low], t[low:high], t[high:]
    if h[3] % 100 < 20:
        return i, len(t), "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return i, len(t), "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_units():
    draw = random.Random(6)
    for size in (0, 1, 7, 8, 9, 63, 64, 65, 1_000):
        text = "".join(draw.choices("aé日\U0001f600\n", k=size))
        units = wordselect.Units(text.encode())
        ends = np.cumsum([0, *(len(c.encode()) for c in text)])
        assert units.select(np.arange(size + 1)).tolist() == ends.tolist()
        assert units.rank(ends).tolist() == list(range(size + 1))


@pytest.mark.parametrize("piece", [8_000_000, 50])
def test_fill_in_middle(spark, odd, empty, monkeypatch, piece):
    monkeypatch.setattr(wordselect, "PIECE_BYTES", piece)
    draw = random.Random(7)
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows += [(100 + n, "".join(draw.choices("<PSM>aé日\U0001f600 ", k=draw.randint(0, 40)))) for n in range(400)]
    rows += [(900 + n, t) for n, t in enumerate(["<P>", "x<M>y", "<S", "<<S>", "<P", "<<P>>"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {n: F.lit(7) for n in ("n", "form", "output", "h1", "prefix_chars")}
    )
    found = wordselect.transform(docs).withColumn(
        "back", wordselect.restored(F.col("output"), F.col("form"))
    ).collect()
    assert sorted((tuple(r[:6]) for r in found), key=str) == sorted((plain_example(*r) for r in rows), key=str)
    texts = sorted((str(i), t or "") for i, t in rows)
    assert sorted((str(r.doc_id), r.back) for r in found) == texts
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert wordselect.transform(empty).count() == 0


def test_other_marks_and_rates(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("some text <P> of a page").alias("text"))
    rates = wordselect.Rates("x", 100, 50, "[pre]", "[suf]", "[mid]")
    found = wordselect.transform(docs, rates)
    back = found.select(wordselect.restored(F.col("output"), F.col("form"), rates)).distinct().collect()
    assert [r[0] for r in back] == ["some text <P> of a page"]
    assert {r.form for r in found.select("form").distinct().collect()} == {"psm", "spm"}
    assert found.where("NOT contains(output, '[mid]')").count() == 0
