"""Mixing, sharding, packing and the pipeline."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from anemoscope.llm import common, countrtree, mixing, packing, sharding, twostage
from tests.llm.conftest import CLASHING, SF, odd_rows


def exponent_of(counts, target):
    """The exponent by plain bisection."""
    counts = np.array(sorted(counts), float)

    def weights(e):
        w = (counts / counts.max()) ** e
        return w / w.sum()

    def entropy(e):
        return -(weights(e) * np.log(weights(e))).sum()

    def repeats(e):
        if target.budget is None:
            return (counts.max() / counts.min()) ** (1 - e)
        return target.budget * weights(e)[0] / counts[0]

    def cross(good):  # good at 0, bad at 1
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if good(middle) else (low, middle)
        return low

    wanted = target.entropy_share * math.log(len(counts))
    flat = 1.0 if entropy(1) >= wanted else cross(lambda e: entropy(e) >= wanted)
    few = target.most_repeats
    seldom = 0.0 if repeats(0) <= few else cross(lambda e: repeats(e) > few)
    e = max(flat, seldom)
    return e, weights(e)


@pytest.mark.parametrize("target", [
    mixing.Target(), mixing.Target(entropy_share=0.999, most_repeats=50),
    mixing.Target(most_repeats=1.2), mixing.Target(budget=500, most_repeats=3), mixing.Target(entropy_share=0.1),
])
def test_weights(spark, target):
    counts = [1000, 400, 90, 50, 50]
    sources = spark.createDataFrame([(f"s{n}", c) for n, c in enumerate(counts)], "source string, tokens long")
    found = mixing.source_weights(sources, target).orderBy("tokens", "source").collect()
    exponent, weights = exponent_of(counts, target)
    assert found[0].exponent == pytest.approx(exponent, abs=1e-9)
    assert [r.weight for r in found] == pytest.approx(weights.tolist(), abs=1e-9)


def mixture_rows(spark):
    rows = [
        (n, " ".join(["w"] * (n % 7 + 1)), s, "x")
        for n, s in enumerate(["a"] * 300 + ["b"] * 60 + ["c"] * 20 + [None] * 30)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, rest string")


@pytest.mark.parametrize("budget", [None, 700])
def test_budgets_are_met(spark, staging, budget):
    target = mixing.Target(budget=budget, most_repeats=4, block_rows=8, entropy_share=0.99)
    docs = mixture_rows(spark)
    taken, weights = mixing.mix(docs, target, staging)
    rows, plan = taken.collect(), weights.collect()
    own = {("" if r.source is None else "=" + r.source, r.doc_id): r for r in docs.collect()}
    copies = collections.Counter()
    for r in rows:
        copies["" if r.source is None else "=" + r.source, r.doc_id] += 1
    for p in plan:
        got = sum(r["__tokens"] for r in rows if ("" if r.source is None else "=" + r.source) == p.source)
        assert p.budget <= got < p.budget + 8
        times = [copies[k] for k in own if k[0] == p.source]
        whole = p.budget // p.tokens
        assert set(times) <= {whole, whole + 1}  # whole passes and a part of one
    assert taken.columns[:4] == docs.columns


@pytest.mark.parametrize("budget", [None, 900, 5000])
def test_mixture_by_plain_loops(spark, staging, budget):
    target = mixing.Target(budget=budget, most_repeats=50, block_rows=8, entropy_share=0.999)
    docs = mixture_rows(spark)
    taken, weights = mixing.mix(docs, target, staging)
    got = collections.Counter((r["__pass"], r.doc_id) for r in taken.collect())
    assert set(got.values()) <= {1}
    plan = {r.source: r for r in weights.collect()}
    hashes = docs.select(
        "doc_id", "text", F.expr("coalesce('=' || source, '')").alias("s"),
        F.xxhash64(F.lit(target.seed), "doc_id", F.length("text")).alias("block"),
    ).collect()
    sizes = collections.Counter(r.s for r in hashes)
    names = spark.createDataFrame(
        [(s, plan[s].budget // plan[s].tokens, b) for s, n in sizes.items() for b in range(-(-n // 8))],
        "s string, p long, block long",
    )
    places = {(r.s, r.block): (r.place, r.block) for r in names.select(
        "s", "block", F.xxhash64(F.lit(target.seed), "p", "s", "block").alias("place")).collect()}
    order = {r.doc_id: (r.h, r.doc_id) for r in docs.join(
        names.select(F.col("s"), "p").distinct(), F.expr("coalesce('=' || source, '') = s")
    ).select("doc_id", F.xxhash64(F.lit(target.seed), "p", "doc_id", "text").alias("h")).collect()}
    wanted = set()
    for source, count in sizes.items():
        whole = plan[source].budget // plan[source].tokens
        left = plan[source].budget - whole * plan[source].tokens
        own = [r for r in hashes if r.s == source]
        wanted |= {(n, r.doc_id) for n in range(whole) for r in own}
        own.sort(key=lambda r: (places[source, r.block % -(-count // 8)], order[r.doc_id]))
        for r in own:
            if left > 0:
                wanted.add((whole, r.doc_id))
            left -= len(r.text.split()) + 1
    assert set(got) == wanted


def test_mixing_edge_cases(spark, odd, staging, empty):
    taken, _ = mixing.mix(odd, mixing.Target(), staging)
    plain = collections.Counter((r.doc_id, r.text) for r in odd.collect())
    got = collections.Counter((r.doc_id, r.text) for r in taken.collect())
    assert set(got) == set(plain) and all(got[k] >= plain[k] for k in plain)
    assert mixing.mix(empty, mixing.Target(), staging)[0].count() == 0


def holds(rows, shards, total):
    counts = collections.Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == total == len(rows) and max(sizes) - min(sizes) <= 1
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_sharding(spark, odd, staging, empty):
    rows = sharding.shard(odd, staging, shards=4).collect()
    holds(rows, 4, odd.count())
    assert sharding.shard(empty, staging).count() == 0
    for r in rows:
        assert r.size >= 16
    texts = collections.Counter(zlib.crc32((r[1] or "").encode()) for r in odd_rows())
    assert collections.Counter(r.text_crc32 for r in rows) == texts


def test_sharding_keeps_groups_together(spark, staging):
    rows = [(n, f"text {n // 5}") for n in range(600)] + [(n, f"alone {n}") for n in range(600, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard(docs, staging, shards=8).collect()
    holds(found, 8, 1000)
    groups = collections.defaultdict(set)
    for r in found:
        if r.doc_id < 600:
            groups[r.doc_id // 5].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 12  # of 120


@pytest.mark.parametrize("copies", [200, 1000])
def test_sharding_of_one_huge_group(spark, staging, copies):
    rows = [(n, "same" if n < copies else f"t{n}") for n in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    holds(sharding.shard(docs, staging, shards=7).collect(), 7, 1000)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(packing.Encoder, "WORDS", 60)  # so that it forgets
    texts = [r[1] for r in odd_rows() if r[0] != 7]
    texts += [f"a{blank * 1_200_000}x" for blank in (" ", "\n", "\t ")] + ["x<|endoftext|>", "<|endoftext|"]
    texts += ["a\n \nb", "a b ", " a", "I'm we'll 12 345x", "a \tb", "<|endoftext|> x", "a\xa0b 　c"]
    library = tokenizer()
    expected = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    assert [x.tolist() for x in packing.Encoder(packing.tokenizer_path()).ids(texts)] == expected


@pytest.mark.parametrize("limits", [
    packing.Limits(), packing.Limits(64, 5, 64), packing.Limits(64, 16, 20),
])
def test_packing(spark, odd, empty, limits):
    pieces = packing.pack(odd, packing.tokenizer_path(), limits).collect()
    library = tokenizer()
    by_text = collections.Counter()
    for r in odd_rows():
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]
        by_text[r[0], tuple(ids)] += 1
    sequences = collections.defaultdict(list)
    texts = collections.defaultdict(lambda: collections.defaultdict(list))
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append(p)
        texts[p.doc_id, p.doc_tokens][p.start].append(bytes(p.ids))
    for found in sequences.values():
        found.sort(key=lambda p: p.offset)
        assert [p.offset for p in found] == np.cumsum([0, *[p.length for p in found]])[:-1].tolist()
        assert sum(p.length for p in found) <= limits.tokens
        assert len(found) <= limits.segments
        assert sum(p.loss_tokens for p in found) <= limits.loss_tokens
    for (doc_id, ids), n in by_text.items():  # every id of every row lies in one piece
        starts = texts[doc_id, len(ids)]
        assert sum(len(b) // 4 for at in starts.values() for b in at) >= n * len(ids)
    assert sum(p.length for p in pieces) == sum(n * len(ids) for (_, ids), n in by_text.items())
    single = [k for k, n in by_text.items() if n == 1 and sum(
        m for (i, x), m in by_text.items() if (i, len(x)) == (k[0], len(k[1]))) == 1]
    for doc_id, ids in single:
        whole = b"".join(b for _, at in sorted(texts[doc_id, len(ids)].items()) for b in at)
        assert np.frombuffer(whole, "<u4").tolist() == list(ids)
    assert packing.pack(empty, packing.tokenizer_path(), limits).count() == 0


def test_packing_pads_little(spark):
    pieces = packing.op9_packing(spark, SF).toPandas()
    used = pieces.groupby("sequence_id").length.sum()
    assert used.sum() / (1024 * len(used)) > 0.99


def test_pipeline_on_odd_rows(spark, odd, empty):
    docs, count = odd, {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        if name != "packing":
            assert found.columns == docs.columns
            docs = common.Staging(spark).stage(found, name)
            count[name] = collections.Counter(r.doc_id for r in docs.collect())
            assert all(r[column] == 7 for r in docs.collect() for column in CLASHING)
    assert not {4, 5, 6, 14} & set(count["language_id"])
    assert count["ngram_jaccard_join"][1] == 1 and not {2, 3} & set(count["ngram_jaccard_join"])
    assert set(count["mixing"]) == set(count["suffix_array_dedup"])
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_short_documents_of_a_known_language_stay(spark):
    texts = ["Von.", "Avec.", "A.", "A.\nAll rights reserved.", "xqzw", "12 !!", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = corpus_pipeline.language_id(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 3, 4]


def test_pipeline_stages_do_what_their_operators_say(spark):
    docs = common.table(spark, SF, "documents")
    staging = common.Staging(spark)
    kept = staging.stage(corpus_pipeline.near_duplicates(spark, docs, SF), "kept")
    found = countrtree.join(docs, countrtree.Rule(), staging)
    expected = {r.doc_id for r in found.collect() if r.doc_id == r.component_id}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    cut = corpus_pipeline.repeated_passages(spark, kept, SF).collect()
    texts = {r.doc_id: r for r in twostage.deduplicate(kept).collect()}
    for r in cut:
        assert r.n_chars == len(r.text)
        if not texts[r.doc_id].n_removed:
            assert r.text.encode() == bytes(texts[r.doc_id].kept)
        else:  # no more goes than the operator says, and cut characters stay whole
            assert len(r.text.encode()) >= texts[r.doc_id].n_bytes - texts[r.doc_id].n_removed
    assert {r.doc_id for r in cut} >= {i for i, r in texts.items() if not r.n_removed}
    staging.release()
