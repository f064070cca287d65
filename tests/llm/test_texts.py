"""Toxicity, quality rules, language-model scoring and language identification."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from anemoscope.llm import common, contextmix, gapkernel, hyperlang, linecrf
from tests.llm.conftest import SF, odd_rows

LARGER = SF.replace("sf0.001", "sf0.01")


def fold(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


def subsequences(word):
    """Each three-letter subsequence with its least span, by plain loops."""
    found = {}
    for i in range(len(word)):
        for j in range(i + 1, min(len(word), i + gapkernel.GAP + 2)):
            for k in range(j + 1, min(len(word), j + gapkernel.GAP + 2)):
                value = gapkernel.DECAY ** (k - i + 1)
                key = word[i] + word[j] + word[k]
                found[key] = max(found.get(key, 0), value)
    return found


def test_kernel_is_that_of_plain_loops():
    marks = ["^idiot", "^moron", "the", "^äüaxa", "^aaaa"]
    words = [*marks, "^idxiot", "^ororon", "moron", "", "^zzz", "^aaaaaaa", "^ü𝄞aäüa"]
    kernel = gapkernel.Kernel(marks)
    found, likeness = kernel(words), kernel.likeness(words)
    for m, mark in enumerate(marks):
        own = subsequences(mark)
        for n, word in enumerate(words):
            other = subsequences(word)
            norm = sum(v * v for v in own.values()) * sum(v * v for v in other.values())
            value = sum(v * own.get(u, 0) for u, v in other.items()) / norm**0.5 if norm else 0
            assert likeness[n, m] == pytest.approx(value, abs=1e-9)
            assert found[n, m] == pytest.approx(math.exp(gapkernel.SHARP * (value - 1)))
    whiten = kernel.whitening()
    assert np.allclose(whiten @ kernel(marks) @ whiten, np.eye(len(marks)), atol=1e-6)


def toxic_sample():
    draw = np.random.default_rng(5)
    words = ["".join(draw.choice(list("abcdeghl"), 5)) for _ in range(300)]
    rows = []
    for n in range(240):
        text = [str(w) for w in draw.choice(words, 30)]
        if n % 4 == 0:
            text[int(draw.integers(30))] = ("mutzik", "provnar")[n % 8 // 4]
        rows.append((int(n % 4 == 0), " ".join(text)))
    return rows


def scored(machine, *texts):
    sets = [{w for w in map(gapkernel.letters_of, gapkernel.distinct_words(t)) if w} for t in texts]
    return machine.score(sets, gapkernel.Words(machine.kernel))


def test_toxicity_of_plain_and_disguised_words():
    machine = gapkernel.train(toxic_sample())
    scores, worst = scored(machine, "abc mutzik", "Provnar, dale", "abc mutzxik", "abc abcde", "")
    assert min(scores[:2]) > 0.7 and worst[:2] == ["mutzik", "provnar"]
    assert scores[2] > 0.5 > 0.3 > max(scores[3:]) and worst[4] is None
    assert gapkernel.spaced_out([b"m", b"u", b"t", b"z", b"ik", b"a", b"b"]) == [b"mutz"]
    assert gapkernel.letters_of("M-u_t.z1ik".lower().encode()) == "mutzik"


def test_toxicity_chance_and_copies():
    for found, among, share in ((3, 5, 0.2), (0, 4, 0.5), (7, 7, 0.1), (2, 9, 0.6)):
        wanted = sum(
            math.comb(among, n) * share**n * (1 - share) ** (among - n)
            for n in range(found, among + 1)
        )
        assert gapkernel.by_chance(found, among, share) == pytest.approx(wanted)
    base = {f"w{n}" for n in range(40)}
    other = {f"v{n}" for n in range(40)}
    texts = [base, base - {"w1"} | {"x"}, other, set(), {"w1", "v1"}]
    assert gapkernel.without_near_copies(texts) == [base, other, set(), {"w1", "v1"}]


def test_rare_insults_are_landmarks_at_any_size():
    draw = np.random.default_rng(7)
    common_words = ["".join(draw.choice(list("abcdeghl"), 5)) for _ in range(60)]
    for often in (1, 8):
        toxic = [{*draw.choice(common_words, 9), "mutzik"} for _ in range(60 * often)]
        toxic += [{*draw.choice(common_words, 9), "provnar"} for _ in range(8)]
        toxic += [set(draw.choice(common_words, 9)) for _ in range(10)]
        clean = [set(draw.choice(common_words, 9)) for _ in range(300 * often)]
        mined, contrast = gapkernel.mine_landmarks(toxic, clean)
        assert sorted(mined) == ["^mutzik", "^provnar"]
        assert len(contrast) == 8 and not set(contrast) & set(mined)


def test_toxicity_without_labels_or_rows(spark, odd, empty):
    machine = gapkernel.train([])
    found = gapkernel.score(odd, machine).collect()
    assert len(found) == odd.count() and max(r.score for r in found) < 1e-6
    assert gapkernel.score(empty, gapkernel.train(toxic_sample())).count() == 0
    scores = gapkernel.score(odd, gapkernel.train(toxic_sample())).collect()
    assert all(0 <= r.score <= 1 for r in scores)
    assert {r.worst for r in scores if r.doc_id in (4, 5, 6, 14)} == {None}


def test_toxicity_holds_out(spark):
    query = gapkernel.op1_toxicity(spark, LARGER).toPandas()
    docs = common.table(spark, LARGER, "documents").toPandas().set_index("doc_id")
    labels = common.table(spark, LARGER, "labels").toPandas().set_index("doc_id").toxic
    assert (query.held_out == [fold(i, 3) == 1 for i in query.doc_id]).all()
    assert (query.predicted == (query.score >= 0.7)).all()
    held = query[query.held_out & query.doc_id.isin(labels.index)]
    truth = labels.loc[held.doc_id].to_numpy()
    clean = [set(gapkernel.distinct_words(docs.text[i])) for i in labels.index[labels == 0]]
    insults = set().union(*(
        gapkernel.distinct_words(docs.text[i]) for i in labels.index[labels == 1]
    )) - set().union(*clean)
    often = collections.Counter(
        w for i in labels.index[labels == 1]
        for w in gapkernel.distinct_words(docs.text[i]) & insults
    )
    plain = {w for w, n in often.items() if n >= 8}  # words of toxic documents alone
    holds = [bool(plain & gapkernel.distinct_words(docs.text[i])) for i in held.doc_id]
    caught = held.predicted.to_numpy()[(truth == 1) & holds]
    assert len(caught) > 5 and caught.mean() >= 0.9
    assert held.predicted.to_numpy()[truth == 0].mean() < 0.01


def base_counts(text):
    words = [w.encode() for w in (text or "").translate(
        {ord(c): " " for c in common.BLANKS}).split(" ") if w]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for n in range(len(words) - 2):
        if windows[tuple(words[n : n + 3])] > 1:
            covered.update((n, n + 1, n + 2))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if line.translate({ord(c): None for c in common.BLANKS}):
            again += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in linecrf.SYMBOLS for c in text or "")
    return len(words), chars, symbols, again, len(covered)


def test_quality_counts(spark, odd, empty):
    chain = linecrf.Chain(np.eye(len(linecrf.FEATURES))[0])
    found = linecrf.judge(odd, chain).collect()
    expected = sorted(base_counts(r[1]) for r in odd_rows())
    names = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    assert sorted(tuple(r[n] for n in names) for r in found) == expected
    for r in found:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert linecrf.judge(empty, chain).count() == 0


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(1)
    for _ in range(30):
        chain = linecrf.Chain(draw.normal(size=len(linecrf.FEATURES)), draw.normal(size=(2, 2)))
        features = draw.normal(size=(6, len(linecrf.FEATURES)))
        gains = features @ chain.weights
        value = lambda path: sum(g for g, s in zip(gains, path, strict=True) if s) + sum(
            chain.moves[a, b] for a, b in zip(path, path[1:]))
        best = max((tuple(n >> k & 1 for k in range(6)) for n in range(64)), key=value)
        assert value(chain.decode(features)) == pytest.approx(value(best))


def test_quality_learns_labels(spark):
    found = linecrf.op2_quality_rules(spark, SF).toPandas().set_index("doc_id")
    labels = common.table(spark, SF, "labels").toPandas().set_index("doc_id").quality
    texts = found.loc[labels.index]
    good = texts[(labels == 1) & ~texts.base_failed]
    assert good.kept.mean() > 0.95
    assert texts[labels == 0].kept.mean() < 0.3


def test_scores_are_those_of_plain_counting(spark, odd, staging, empty):
    docs = odd.select("doc_id", "text").withColumn("held_out", F.coalesce(F.col("doc_id") % 4 == 0, F.lit(False)))
    model = contextmix.learn(docs.where("not held_out"))
    found = contextmix.score(docs, model, staging).collect()
    rows = [(r[0], contextmix.tokens_of(r[1]) + [b"\n"]) for r in odd_rows()]
    train = collections.Counter(w for i, ws in rows if i is None or i % 4 for w in ws)
    total, distinct = sum(train.values()), len(train)
    expected = sorted(
        (len(ws), sum(train[w] > 0 for w in ws), round(sum(
            math.log10((train[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), 6))
        for _, ws in rows
    )
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
    assert {r.train_tokens for r in found} == {total}
    assert all(r.score < 0 for r in found)
    nothing = empty.select("doc_id", "text", F.lit(True).alias("held_out"))
    assert contextmix.score(nothing, contextmix.learn(nothing), staging).count() == 0


def test_model_is_a_distribution():
    """The probabilities of all bytes after a context add up to one."""
    tokens = [b"abc ", b"abd ", b"xyz ", b"\n"]
    seen, ones = np.zeros(contextmix.SLOTS), np.zeros(contextmix.SLOTS)
    contextmix.count(tokens, np.array([5.0, 3.0, 2.0, 4.0]), seen, ones)
    model = contextmix.fit_mixer(seen, ones, [[b"abc", b"abd"]] * 20)
    start = model.log10([b"ab"])[0]
    every = model.log10([b"ab" + bytes([n]) for n in range(256)])
    assert sum(10 ** (every - start)) == pytest.approx(1, abs=1e-4)
    assert model.log10([b"abc "])[0] > model.log10([b"aqc "])[0]


def many_words(count=400):
    draw = np.random.default_rng(11)
    letters = list("abcdefghé")
    words = ["".join(draw.choice(letters, draw.integers(1, 8))) for _ in range(3_000)]
    return [(n, " ".join(draw.choice(words, 30))) for n in range(count)]


def one_process(rows):
    words = collections.Counter(w for _, t in rows for w in [*contextmix.tokens_of(t), b"\n"])
    times = dict(zip(contextmix.spelled(words), words.values()))
    tokens = sorted(times)
    needs, occurred = contextmix.counted(tokens, np.array([times[t] for t in tokens]))
    entries, totals = contextmix.summed(list(needs), [occurred] * contextmix.ORDERS)
    return times, (entries, totals, np.searchsorted(entries, needs), occurred)


def test_every_context_has_its_own_counts(spark, monkeypatch):
    monkeypatch.setattr(contextmix, "PER_PART", 10_000)
    rows = many_words()
    model = contextmix.learn(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert model.parts > 3
    expected = collections.Counter()
    for token, n in one_process(rows)[0].items():
        for i, byte in enumerate(token):
            for order in range(4):
                expected[order, token[max(0, i - order - 1) : i], i <= order, byte] += n
            expected[4, token[:i], True, byte] += n
    found = collections.Counter()
    for r in model.contexts.collect():
        for e, n in zip(contextmix.unpack(r["first"], "<u8", True).tolist(), contextmix.unpack(r["second"]).tolist()):
            assert e not in found
            found[e] = n
    for order in range(5):
        own = collections.Counter((e & 255, n) for e, n in found.items() if e >> 8 & 7 == order)
        assert own == collections.Counter((k[3], n) for k, n in expected.items() if k[0] == order)


def test_nodes_are_hashed_once(monkeypatch):
    """Contexts of shared beginnings are taken once, and are those of all bytes."""
    words = {w.encode() for _, text in many_words(60) for w in text.split()}
    tokens = sorted([*contextmix.spelled(words), contextmix.END_OF_TEXT, b"x" * 70_000 + b" "])
    every = contextmix.positions(tokens)
    hashed = []
    whole = contextmix.positions
    monkeypatch.setattr(contextmix, "positions", lambda *a: hashed.append(whole(*a)) or hashed[-1])
    token, node, needs = contextmix.nodes_of(tokens)
    begins = {}
    for at, (t, n) in enumerate(zip(token.tolist(), node.tolist())):
        place = at - sum(map(len, tokens[:t])) if at < 2_000 else None
        if place is not None:
            assert begins.setdefault(tokens[t][: place + 1], n) == n
    assert len(set(begins.values())) == len(begins)
    entries = every[2] >> np.uint64(11) << np.uint64(11)
    entries |= (np.arange(contextmix.ORDERS, dtype=np.uint64) << np.uint64(8))[:, None]
    assert (needs[:, node] == entries | every[1].astype(np.uint64)).all()
    assert sum(found[2].shape[1] for found in hashed) == needs.shape[1] < len(node)


def test_weights_are_learned_from_all_texts(spark, monkeypatch):
    monkeypatch.setattr(contextmix, "PER_PART", 10_000)
    rows = many_words()
    _, arrays = one_process(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    model = contextmix.learn(docs)
    weights, refine = contextmix.fit(lambda what, weights: what(weights, *arrays))
    assert model.weights == pytest.approx(weights, abs=1e-6)
    assert model.refine == pytest.approx(refine, abs=1e-6)
    start = np.full_like(weights, contextmix.START)
    at_start = contextmix.slopes(start, *arrays)
    assert contextmix.slopes(weights, *arrays)[0] < at_start[0]
    for cell in np.argsort(-abs(at_start[1:211]))[:5]:
        moved = start.ravel().copy()
        moved[cell] += 1e-5
        change = (contextmix.slopes(moved.reshape(start.shape), *arrays)[0] - at_start[0]) / 1e-5
        assert -change == pytest.approx(at_start[1 + cell], rel=1e-2)


def test_mixture_is_a_distribution():
    _, (entries, totals, at, times) = one_process(many_words(50))
    weights, refine = contextmix.fit(lambda what, w: what(w, entries, totals, at, times))
    for head in (b"a", b"ab", b"bac", b"zz"):
        start = contextmix.log10_of([head], entries, totals, weights, refine)[0]
        tokens = [head + bytes([n]) for n in range(256)]
        every = contextmix.log10_of(tokens, entries, totals, weights, refine)
        assert sum(10 ** (every - start)) == pytest.approx(1, abs=1e-9)


def test_language_edge_cases(spark, odd, empty):
    profiles = hyperlang.learn(odd, F.lit(True))
    assert profiles.languages == ("en", "fr")
    found = hyperlang.predict(odd, profiles, ("__l", "__s")).collect()
    assert len(found) == odd.count()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r["__l"] == "und") == (not letters) and 0 <= r["__s"] <= 1
    nothing = hyperlang.learn(empty, F.lit(True))
    assert {r.lang_pred for r in hyperlang.predict(odd, nothing).collect()} == {"und"}
    assert hyperlang.predict(empty, profiles).count() == 0


def test_bundle_of_plain_loops():
    vectors = hyperlang.Vectors(64)
    grams, counts = hyperlang.grams_of("Ab  c1a")
    padded = "\0ab\0c\0a\0"
    total = np.zeros(64)
    letter = lambda c: vectors.letter(ord(c)).astype(int)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        total += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    assert counts.sum() == len(padded) - 2
    assert (vectors.bundle(grams, counts) == total).all()


def test_languages_held_out(spark):
    found = hyperlang.op10_language_id(spark, SF).toPandas().set_index("doc_id")
    docs = common.table(spark, SF, "documents").toPandas().set_index("doc_id")
    held = found[found.held_out]
    assert (held.index.map(lambda i: fold(i, 5)) == 0).all()
    assert (held.lang_pred == docs.loc[held.index].lang).mean() > 0.95
