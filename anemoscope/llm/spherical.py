"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Vectors of a label are parted into cells by the nearest centre, found by spherical
k-means on a bounded sample. A vector is copied to every other cell that could hold a
partner: with unit vectors no farther apart than ``d``, the gain of one centre over
another differs by at most ``d`` times the centres' distance. So no pair is missed. Each
cell is cut into blocks, pairs of blocks are multiplied, and every pair counts once, in
the home cell of its smaller id.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common, graph

LEAST_COSINE = 0.98
#: Vectors that the centres of all labels are learned from, at most, and their rounds.
SAMPLE, ROUNDS = 20_000, 8
#: Vectors to a centre, centres of all labels at most, and rows of a block.
PER_CELL, MOST_CENTRES, BLOCK = 2_000, 4_000, 1_000
#: Products in double precision may differ from exact ones by this much; closer to the
#: threshold they are computed again. Rows compared with the centres at once.
SLACK, AT_ONCE = 1e-12, 500


def usable() -> Column:
    """Whether a row has a label and a vector of finite numbers that is not zero."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))


def unit(vectors) -> np.ndarray:
    x = np.array(list(vectors), np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine of two vectors of double precision, from sums rounded once."""
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    dot, xx, yy = (math.fsum(p) for p in (x * y, x * x, y * y))
    return dot / (math.sqrt(xx) * math.sqrt(yy))


def centres_of(x: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from spread starting points; deterministic."""
    count = min(count, len(x))
    chosen = [0]
    nearest = x @ x[0]
    for _ in range(count - 1):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(ROUNDS):
        cell = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def learn_centres(distinct: DataFrame) -> dict[tuple, np.ndarray]:
    """Centres by label and length of vector, from a bounded sample by hash."""
    kinds = distinct.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
    kinds = kinds.orderBy(F.desc("n"), "label", "size").limit(MOST_CENTRES).collect()
    order = F.xxhash64("label", "vec")
    sample = distinct.select("label", "size", "embedding").orderBy(order).limit(SAMPLE).toPandas()
    share = max(1.0, sum(-(-k.n // PER_CELL) for k in kinds) / MOST_CENTRES)
    centres = {}
    of = {k: part for k, part in sample.groupby(["label", "size"])}
    for k in kinds:
        part = of.get((k.label, k.size))
        if part is not None:
            count = max(1, int(-(-k.n // PER_CELL) / share))
            centres[k.label, k.size] = centres_of(unit(part.embedding), count)
    return centres


def _reach(cosine: float) -> float:
    """Distance of two unit vectors with this cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9


def near_duplicates(
    vectors: DataFrame, staging: common.Staging, least: float = LEAST_COSINE
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    ``vectors`` needs ``vec_id``, ``embedding`` and ``label``; other columns are ignored.
    Only vectors with equal labels and equally many components are compared. Null and zero
    vectors, those with null or non-finite components, and rows without a label link with
    nothing and are kept. Equal vectors are one point with a weight, so a group of copies
    costs as much as one of them. The row with the smallest id of a component is kept;
    of repeated rows with that id, all. Null ids sort after all others. An empty table gives
    no rows.
    """
    rows = vectors.select("vec_id", "label", "embedding")
    good = rows.where(usable()).withColumn("vec", F.xxhash64("label", "embedding"))
    good = good.withColumn("vec2", F.xxhash64(F.lit(1), F.reverse("embedding")))
    point = ["label", "vec", "vec2"]
    distinct = good.groupBy(*point).agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"),
        F.first("embedding").alias("embedding"),
    )
    distinct = distinct.withColumn("size", F.size("embedding"))
    distinct = staging.stage(distinct, "distinct")
    centres = learn_centres(distinct)
    reach = _reach(least)
    kinds = dict(distinct.dtypes)
    columns = ["label", "vec", "vec2", "copies", "size", "embedding"]
    placed = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", cell long, home long"

    def place(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            parts = []
            for (label, size), part in batch.groupby(["label", "size"]):
                own = centres.get((label, size))
                if own is None or len(own) == 1:
                    parts.append(part.assign(cell=0, home=0))
                    continue
                squares = (own * own).sum(1)
                for start in range(0, len(part), AT_ONCE):
                    some = part.iloc[start : start + AT_ONCE]
                    gains = unit(some.embedding) @ own.T
                    home = gains.argmax(1)
                    best = gains[np.arange(len(some)), home]
                    apart = squares[home][:, None] + squares - 2 * (own[home] @ own.T)
                    apart = np.sqrt(np.maximum(apart, 0)) + 1e-7  # rounding only adds copies
                    at, cell = np.nonzero(best[:, None] - gains <= reach * apart + 1e-9)
                    parts.append(some.iloc[at].assign(cell=cell, home=home[at]))
            if parts:
                out = pd.concat(parts)
                yield out.astype({"cell": "int64", "home": "int64"})

    cells = staging.stage(distinct.select(*columns).mapInPandas(place, placed), "cells")
    sizes = cells.groupBy("label", "size", "cell").agg(F.count(F.lit(1)).alias("in_cell"))
    blocks = F.ceil(F.col("in_cell") / BLOCK)
    sizes = sizes.select("label", "size", "cell", blocks.alias("blocks"))
    cells = cells.join(sizes, ["label", "size", "cell"])
    cells = cells.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "vec", "vec2"), F.col("blocks")))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    pairs = cells.withColumn("other", F.explode(others))
    pairs = pairs.withColumns({
        "first": F.least("block", "other"), "second": F.greatest("block", "other"),
    }).drop("other", "blocks")

    def compare(key, part):
        """Links between two blocks: weighted counts, and a spanning link for every point."""
        first, second = key[3], key[4]
        part = part.sort_values(["vec", "vec2"], ignore_index=True)
        x = unit(part.embedding)
        left = np.flatnonzero(part.block == first)
        right = left if first == second else np.flatnonzero(part.block == second)
        vec, copies = part.vec.to_numpy(), part.copies.to_numpy()
        counts = np.zeros(len(part), np.int64)
        partner = np.full(len(part), -1)
        at_home = part.home.to_numpy() == key[2]
        values = x[left] @ x[right].T
        close = values >= least - SLACK
        for n, m in zip(*np.nonzero(close & (values <= least + SLACK)), strict=True):
            one, two = (part.embedding.iloc[at].astype(np.float64) for at in (left[n], right[m]))
            close[n, m] = cosine(one, two) >= least
        a, b = np.nonzero(close)
        a, b = left[a], right[b]
        once = a < b if first == second else np.ones(len(a), bool)
        # Both cells of a pair may hold both points: the home of the smaller one counts.
        once &= at_home[np.minimum(a, b)]
        a, b = a[once], b[once]
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        parent = np.arange(len(part))

        def root(n: int) -> int:
            while parent[n] != n:
                parent[n] = parent[parent[n]]
                n = parent[n]
            return n

        for n, m in zip(a.tolist(), b.tolist(), strict=True):
            n, m = root(n), root(m)
            if n != m:
                parent[max(n, m)] = min(n, m)
                partner[max(n, m)] = min(n, m)
        some = np.flatnonzero((counts > 0) | (partner >= 0))
        to = partner[some]
        return pd.DataFrame({
            "label": part.label.iloc[some], "vec": vec[some], "vec2": part.vec2.iloc[some],
            "n": counts[some],
            "to": np.where(to >= 0, vec[to], vec[some]),
            "to2": np.where(to >= 0, part.vec2.to_numpy()[to], part.vec2.iloc[some]),
        })

    schema = f"label {kinds['label']}, vec long, vec2 long, n long, to long, to2 long"
    found = pairs.groupBy("label", "size", "cell", "first", "second").applyInPandas(compare, schema)
    found = staging.stage(found, "found")
    counted = found.groupBy(*point).agg(F.sum("n").alias("n"))
    name = lambda *c: F.concat_ws(":", *(F.col(x).cast("string") for x in ("label", *c)))
    links = found.select(name("vec", "vec2").alias("a"), name("to", "to2").alias("b"))
    reached = graph.components(links, staging)
    points = distinct.select(*point, "copies", "low", name("vec", "vec2").alias("node"))
    points = points.join(reached, "node", "left").join(counted, point, "left")
    points = points.withColumn("component", F.coalesce("component", "node"))
    lowest = points.groupBy("component").agg(F.min("low").alias("component_id"))
    points = points.join(lowest, "component").select(
        *point, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    points = staging.stage(points, "points")
    linked = good.select("vec_id", *point).join(points, point).select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where(~usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return near_duplicates(common.table(spark, sf_dir, "embeddings"), common.Staging(spark))
