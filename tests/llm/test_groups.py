"""Suffix arrays, near duplicates of texts and vectors, and components."""

import hashlib
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from anemoscope.llm import common, countrtree, graph, spherical, twostage
from tests.llm.conftest import CLASHING, SF, odd_rows, root_of


def test_components(spark, staging):
    draw = random.Random(2)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(180)]
    links += [(n, n + 1) for n in range(1000, 1100)] + [(5, 5), (None, 4)]
    parent = {}
    for a, b in links:
        if a is not None:
            a, b = root_of(parent, a), root_of(parent, b)
            parent[max(a, b)] = min(a, b)
    found = graph.components(spark.createDataFrame(links, "a int, b int"), staging).collect()
    alone = {a for a, b in links if a == b}
    found = {r.node: r.component for r in found}
    assert all(found.get(n, n) == root_of(parent, n) for n in parent)
    assert set(found) >= set(parent) - alone


def test_no_link_below_the_threshold(spark, staging):
    """Cosines of 49/50, and less by half the precision of products, with equal labels."""
    vectors = [[1, 0, 0, 0], [49, 9, 3, 3], [-1, 0, 0, 0], [-49, 9, 3, 3 + 4e-10]]
    rows = spark.createDataFrame(
        [(n, "x", list(map(float, v))) for n, v in enumerate(vectors)], "vec_id long, label string, embedding array<double>"
    )
    found = {r.vec_id: (r.n_links, r.component_id) for r in
             spherical.near_duplicates(rows, staging, 0.98).collect()}
    assert found == {0: (1, 0), 1: (1, 0), 2: (0, 2), 3: (0, 3)}


def test_cells_hold_every_partner(spark, staging, monkeypatch):
    """Many small cells, so that partners lie in different ones."""
    monkeypatch.setattr(spherical, "PER_CELL", 5)
    monkeypatch.setattr(spherical, "BLOCK", 7)
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 3))
    x = np.concatenate([base + draw.normal(size=base.shape) * 0.1 for _ in range(4)])
    rows = [(n, v.tolist(), 1) for n, v in enumerate(x)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    wanted = ((units @ units.T) >= 0.98).sum(1) - 1
    found = spherical.near_duplicates(docs, staging).collect()
    assert [r.n_links for r in sorted(found)] == wanted.tolist() and wanted.sum() > 50


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh", "\x00\x01\xff"])
def test_two_stage_order(letters):
    draw = random.Random(4)
    for size in (1, 2, 17, 400):
        text = np.array([ord(c) for c in draw.choices(letters, k=size)], np.uint8)
        data, depth = text.tobytes(), 24
        order = twostage.two_stage_order(text, depth)
        assert sorted(order.tolist()) == list(range(size))
        prefixes = [data[i : i + depth] for i in order]
        assert prefixes == sorted(prefixes)
        wanted = np.array([draw.random() < 0.3 for _ in range(size)])
        some = [i for i in twostage.two_stage_order(text, depth, wanted).tolist() if wanted[i]]
        assert sorted(some) == np.flatnonzero(wanted).tolist()
        assert [data[i : i + depth] for i in some] == sorted(data[i : i + depth] for i in some)


def removed(rows, width=50):
    """What goes of every row, by a table of all windows."""
    order = lambda i: twostage.LAST if i is None else i
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for n in range(len(data) - width + 1):
            w = data[n : n + width]
            first[w] = min(first.get(w, twostage.LAST), order(i))
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for n in range(len(data) - width + 1):
            if first[data[n : n + width]] < order(i):
                gone[n : n + width] = b"\1" * width
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        yield i, len(data), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), kept


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def test_repeated_passages(spark, odd, staging, empty):
    found = twostage.deduplicate(odd)
    found = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows = [*rows]
    expected = sorted(removed(rows), key=key)
    assert sorted(((*r[:4], bytes(r[4])) for r in found), key=key) == expected
    assert sum(r.n_removed for r in found) > 1000
    assert twostage.deduplicate(empty).count() == 0


def test_repetitive_bytes(spark, staging):
    texts = ["a" * 300, "b" + "a" * 120 + "c", "ab" * 100, "x" * 49, "x" * 49, "é" * 80, "aé" * 60, "é" * 90]
    rows = list(enumerate(texts))
    found = twostage.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [(*r[:4], bytes(r[4])) for r in found.orderBy("doc_id").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()]
    assert got == list(removed(rows))


def test_whole_characters():
    data = "aéçb".encode()  # a, two bytes, two bytes, b
    assert twostage.whole_characters(data, [2], [5]) == ([3], [5])
    assert twostage.whole_characters(data, [1], [4]) == ([1], [3])
    assert twostage.whole_characters(data, [2], [4]) == ([], [])


def test_passages_of_whole_table(spark):
    rows = [tuple(r) for r in common.table(spark, SF, "documents").select("doc_id", "text").collect()]
    expected = {i: (n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in removed(rows)}
    found = twostage.op6_suffix_array_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == expected


def sets_of(rows, words):
    for i, text in rows:
        found = (text or "").encode().lower().split()
        if len(found) >= words:
            yield i, frozenset(tuple(found[n : n + words]) for n in range(len(found) - words + 1))
        else:
            yield i, frozenset([tuple(found)] if found else [])


def linked(rows, rule):
    """Rows' set sizes and components by comparing all pairs."""
    sets = list(sets_of(rows, rule.words))
    parent = {}
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= rule.percent * len(sets[a][1] | sets[b][1]):
                x, y = root_of(parent, a), root_of(parent, b)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for n, (i, _) in enumerate(sets):
        groups.setdefault(root_of(parent, n), []).append(i)
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, len(s), low[root_of(parent, n)]) for n, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("rule", [countrtree.Rule(3, 90), countrtree.Rule()])
def test_jaccard_join(spark, odd, staging, empty, rule):
    rows = [(r[0], r[1]) for r in odd_rows()]
    draw = random.Random(9)
    base = [f"w{draw.randint(0, 900)}" for _ in range(150)]
    for n in range(100, 180):  # near copies of near copies
        base = list(base)
        base[draw.randint(0, len(base) - 1)] = f"x{n}"
        if n % 3 == 0:
            base.append(f"y{n}")
        rows.append((n, " ".join(base)))
    rows += [(n, " ".join(f"t{draw.randint(0, 3)}" for _ in range(draw.randint(1, 7)))) for n in range(200, 260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cluster", F.lit(1))
    found = countrtree.join(docs, rule, staging).select("doc_id", "n_shingles", "component_id")
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found.collect()), key=order) == sorted(linked(rows, rule), key=order)
    assert countrtree.join(empty, rule, staging).count() == 0
    assert countrtree.join(odd, rule, staging).count() == odd.count()


def test_signatures_lose_no_link():
    """Sets as different as the rule allows still share a signature, at all sizes."""
    draw = np.random.default_rng(6)
    for rule in (countrtree.Rule(3, 90), countrtree.Rule(5, 80)):
        for size in (1, 5, 9, 10, 11, 37, 100, 333, 1000, 4000):
            for _ in range(5):
                a = np.unique(draw.integers(0, 2**63, size, np.int64).astype(np.uint64))
                for more in (0, 0.5, 1):  # left out of one, and new in the other
                    spare = rule.spare(len(a))
                    out = int(spare * (1 - more) / 2)
                    b = np.unique(np.concatenate((
                        a[out:], draw.integers(0, 2**63, int(out * more), np.int64).astype(np.uint64))))
                    both = len(np.intersect1d(a, b))
                    if 100 * both >= rule.percent * (len(a) + len(b) - both):
                        shared = set(countrtree.signatures(a, rule)) & set(countrtree.signatures(b, rule))
                        assert shared


def test_leaves_of_a_large_group(spark, staging, monkeypatch):
    monkeypatch.setattr(countrtree, "LEAF", 7)
    draw = random.Random(8)
    base = [f"w{n}" for n in range(120)]
    rows = []
    for n in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randint(0, 119)] = f"z{draw.randint(0, 50)}"
        rows.append((n, " ".join(words)))
    rule = countrtree.Rule(3, 80)
    found = countrtree.join(spark.createDataFrame(rows, "doc_id long, text string"), rule, staging)
    found = found.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == sorted(linked(rows, rule))


def test_leaves_are_as_few_with_many_partitions(spark, staging, monkeypatch):
    """Near copies of a base, most of them not linked, dealt over more partitions than leaves."""
    monkeypatch.setattr(countrtree, "LEAF", 64)
    draw = random.Random(9)
    rows = []
    for n in range(200):
        words = [f"w{k}" for k in range(150)]
        for k in range(draw.choice([1, 4, 4, 4])):
            words[draw.randint(0, 149)] = f"z{n}-{k}"
        rows.append((n, " ".join(words)))
    staged = {}
    monkeypatch.setattr(
        staging, "stage", lambda table, label, f=staging.stage: staged.setdefault(label, f(table, label))
        if label == "bounds" else f(table, label),
    )
    monkeypatch.setattr(staging, "discard", lambda *labels: None)
    docs, rule = spark.createDataFrame(rows, "doc_id long, text string"), countrtree.Rule(3, 90)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = countrtree.join(docs, rule, staging).select("doc_id", "n_shingles", "component_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, found)) == sorted(linked(rows, rule))
    assert staged["bounds"].count() <= 8


def test_sets_are_sent_of_points_that_could_be_linked(spark, staging, monkeypatch):
    """One pair of near copies among texts that only share a passage: two sets are compared."""
    draw = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(n, passage + " " + " ".join(f"u{n}-{k}" for k in range(60))) for n in range(40)]
    rows.append((40, rows[7][1] + " more"))
    draw.shuffle(rows)
    staged = {}
    monkeypatch.setattr(
        staging, "stage", lambda table, label, f=staging.stage: staged.setdefault(label, f(table, label))
        if label in ("members", "early", "late") else f(table, label),
    )
    monkeypatch.setattr(staging, "discard", lambda *labels: None)
    docs, rule = spark.createDataFrame(rows, "doc_id long, text string"), countrtree.Rule(3, 90)
    found = countrtree.join(docs, rule, staging).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == sorted(linked(rows, rule))
    assert staged["members"].count() > 20
    assert staged["early"].select("set1", "set2").distinct().count() == 2
    assert staged["late"].count() == 0


@pytest.mark.parametrize("rule", [countrtree.Rule(3, 90), countrtree.Rule()])
def test_texts_that_share_a_frequent_passage_make_no_cluster(spark, staging, monkeypatch, rule):
    """Only near copies are members of clusters, and no staged table holds their sets."""
    monkeypatch.setattr(countrtree, "COUNTED", 0, raising=False)
    draw = random.Random(13)
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(n, passage + " " + " ".join(f"u{n}-{k}" for k in range(60))) for n in range(40)]
    rows += [(40, rows[7][1] + " more"), (41, None), (42, ""), (43, "one"), (44, "one"), (45, passage)]
    draw.shuffle(rows)
    staged = {}
    monkeypatch.setattr(
        staging, "stage", lambda table, label, f=staging.stage: staged.update({label: f(table, label)}) or staged[label]
    )
    monkeypatch.setattr(staging, "discard", lambda *labels: None)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = countrtree.join(docs, rule, staging).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == sorted(linked(rows, rule))
    assert staged["members"].count() == 2
    assert not [label for label, table in staged.items() if "shingles" in table.columns]


def test_first_shingles_lose_no_link():
    """Whatever the counts are, linked sets share a signature; shingles that are rare come first."""
    draw = np.random.default_rng(7)
    for rule in (countrtree.Rule(3, 90), countrtree.Rule(5, 80)):
        for size in (1, 2, 5, 11, 100, 1000):
            for most in (1, 3, 256):
                counts = draw.integers(0, most, 1 << 16).astype(np.uint8)
                a = np.unique(draw.integers(0, 2**63, size, np.int64).astype(np.uint64) * np.uint64(2))
                out = int(rule.spare(len(a)) / 2)
                b = np.unique(np.concatenate((a[out:], draw.integers(0, 2**63, out, np.int64).astype(np.uint64))))
                both = len(np.intersect1d(a, b))
                assert 100 * both >= rule.percent * (len(a) + len(b) - both)
                one, two = (countrtree.signatures(s, rule, counts) for s in (a, b))
                assert set(one.tolist()) & set(two.tolist())
    rare = np.ones(1 << 16, np.uint8)
    rare[: 1 << 15] = 9
    found = countrtree.signatures(np.sort(a), rule, rare)
    assert set(found.tolist()) <= set(common.mixed(a[a >= np.uint64(1 << 63)]).tolist())


def test_counts_are_of_documents(spark, staging, monkeypatch):
    monkeypatch.setattr(countrtree, "COUNTED", 0)
    monkeypatch.setattr(countrtree, "COUNTED_TOGETHER", 500)
    rule = countrtree.Rule(3, 90)
    rows = [(n, " ".join(f"w{k}" for k in range(n % 7, 40 + n % 11))) for n in range(400)] + [(0, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = countrtree.shingle_counts(docs, rule, 1 << 23, staging)
    hashes, expected = countrtree.WordHashes(), np.zeros(len(counts), np.int64)
    assert len(counts) == 1 << 18
    for _, text in rows:
        np.add.at(expected, countrtree._count_places(countrtree.shingles(text, 3, hashes), len(counts)), 1)
    assert counts.tolist() == np.minimum(expected, 255).tolist() and max(expected) > 255


def test_able_points_by_plain_loops():
    draw = np.random.default_rng(6)
    rule = countrtree.Rule(3, 80)
    bases = [draw.integers(0, 1 << 62, 60, dtype=np.uint64) for _ in range(4)]
    sets = [np.unique(bases[draw.integers(4)][: draw.integers(20, 61)]) for _ in range(30)]
    part = pd.DataFrame({
        "leaf": draw.integers(0, 2, 30), "n": list(map(len, sets)), "fine": list(map(countrtree.fine_of, sets)),
    })
    for first, second in ((0, 1), (0, 0)):
        expected = set()
        for i in range(30):
            for j in range(30):
                if i == j or part.leaf[i] != first or part.leaf[j] != second:
                    continue
                a, b = (np.frombuffer(part.fine[k], np.uint8).astype(int) for k in (i, j))
                both, n, m = int(np.minimum(a, b).sum()), int(part.n[i]), int(part.n[j])
                if 100 * min(n, m) >= 80 * max(n, m) and 100 * both >= 80 * (n + m - both):
                    expected |= {i, j}
        assert set(np.flatnonzero(countrtree.able_points(part, rule, first, second)).tolist()) == expected
        assert 0 < len(expected) < 30


def test_finer_counts_bound_the_overlap():
    draw = np.random.default_rng(4)
    rule = countrtree.Rule(3, 80)
    for size in (3, 40, 2_000, 150_000):  # the last has counts beyond a byte
        base = np.unique(draw.integers(0, 1 << 62, size, dtype=np.uint64))
        other = np.unique(np.concatenate((base[size // 10 :], draw.integers(0, 1 << 62, size // 20, dtype=np.uint64))))
        far = np.unique(draw.integers(0, 1 << 62, size, dtype=np.uint64))
        n = np.array([len(base), len(other), len(far)])
        counts = countrtree.fine_counts([countrtree.fine_of(s) for s in (base, other, far)])
        able = countrtree.could_link(counts, n, 0, np.array([1, 2]), rule).tolist()
        assert 1 in able and (size > 200 or 2 not in able)


def test_keep_one(spark, odd, staging):
    kept = countrtree.keep_one(odd, countrtree.Rule(), staging)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id or -1) for r in kept.collect())
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and {4, 5, 6, 7, 12} <= set(ids)
    assert all(r[name] == 7 for r in kept.collect() for name in CLASHING)


def test_keep_one_of_rows_with_equal_id_and_text(spark, staging):
    rows = [(1, "a b c d e f", source) for source in ("s3", "s1", None, "s2")]
    docs = spark.createDataFrame([*rows, (2, None, "s"), (2, None, "r")], "doc_id long, text string, source string")
    for parts in (1, 3):
        kept = countrtree.keep_one(docs.repartition(parts), countrtree.Rule(), staging)
        # An absent value writes "{}", which follows every other object.
        assert sorted(map(tuple, kept.collect()), key=str) == [(1, "a b c d e f", "s1"), (2, None, "r")]


def test_staged_tables_go_with_their_use(spark):
    docs = common.table(spark, SF, "documents")
    staging = common.Staging(spark)
    kept = countrtree.keep_one(docs, countrtree.Rule(), staging)
    assert {name.split("-", 1)[1] for name in os.listdir(staging.path)} == {"kept"}
    assert 0 < kept.count() <= docs.count()
    staging.release()
    assert not os.path.exists(staging.path)


VECTORS = "vec_id long, embedding array<float>, label int"


def test_vectors_against_all_pairs(spark, staging, monkeypatch):
    monkeypatch.setattr(spherical, "PER_CELL", 20)
    monkeypatch.setattr(spherical, "BLOCK", 9)
    draw = np.random.default_rng(7)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            centre = draw.normal(size=6)
            for _ in range(int(draw.integers(1, 7))):
                rows.append((n, (centre + draw.normal(size=6) * 0.08).tolist(), label))
                n += 1
    rows += [(n + k, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1) for k in range(30)]
    n += 30
    odd = [None, [], [0.0] * 6, [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [None, 1.0], [1.0, 2.0]]
    rows += [(n + k, v, 1) for k, v in enumerate(odd)]
    rows += [rows[0], (None, [2.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1)]
    docs = spark.createDataFrame(rows, VECTORS).withColumn("cell", F.lit(1)).withColumn("copies", F.lit(1))
    found = spherical.near_duplicates(docs, staging).collect()
    good = [
        k for k, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    parent, links = {}, [0] * len(rows)
    for a in good:
        for b in good:
            x, y = np.float32(rows[a][1]).astype(float), np.float32(rows[b][1]).astype(float)
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98 - 1e-12:
                    links[a] += 1
                    links[b] += 1
                    p, q = root_of(parent, a), root_of(parent, b)
                    parent[max(p, q)] = min(p, q)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root_of(parent, k), []).append(rows[k][0])
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    expected = sorted(
        ((rows[k][0] is None, rows[k][0] or 0, links[k], low[root_of(parent, k)]) for k in range(len(rows))),
        key=str,
    )
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id) for r in found), key=str)
    assert got == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert spherical.near_duplicates(spark.createDataFrame([], VECTORS), staging).count() == 0
