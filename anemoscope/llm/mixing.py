"""Mixing sources to target weights.

Weights are the sources' token shares raised to an exponent and normalised. The exponent
is bisected: the largest one (the least change) at which the mixture has the wanted
entropy, and if that would repeat a source too often, the smallest one that keeps to the
repetition limit. Each source then gets a budget of tokens, met by whole passes over its
documents and a last partial pass. Every pass is a permutation of blocks and of the
documents in each; the partial pass is cut inside one block.

Only DataFrame and SQL expressions are used.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from anemoscope.llm import common

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 50
#: Sources whose plan is broadcast; a longer plan is joined by shuffling.
MOST_BROADCAST = 100_000


@dataclass(frozen=True)
class Target:
    """What the mixture is to reach.

    ``entropy_share``: entropy as a share of the largest one, that of equal weights.
    ``most_repeats``: times that a document is repeated at most, on average of its source.
    ``budget``: tokens of the mixture; by default just enough for every source to be
    passed whole, so that no document is left out.
    """

    entropy_share: float = 0.97
    most_repeats: float = 2.0
    budget: int | None = None
    block_rows: int = 2_000
    seed: int = 17


def tokens_of(text: Column) -> Column:
    """Words of a text and one end, so that an empty text weighs something."""
    return (F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)) + 1).cast("long")


def source_weights(sources: DataFrame, target: Target) -> DataFrame:
    """Adds ``exponent``, ``weight``, ``budget`` and ``repeats`` to ``source`` and ``tokens``.

    The bisection is one expression over the list of token counts. Entropy rises as the
    exponent falls from 1 to 0 and repetition with it, so both have one crossing.
    """
    top = "aggregate(counts, cast(0 as double), (a, c) -> greatest(a, c))"
    total = f"aggregate(counts, cast(0 as double), (a, c) -> a + pow(c / {top}, e))"
    # With w = (c / top)^e / total: entropy = ln(total) - sum(w * ln((c / top)^e)).
    moment = (
        f"aggregate(counts, cast(0 as double), (a, c) -> a + pow(c / {top}, e) * e * ln(c / {top}))"
    )
    low = "aggregate(counts, cast(1e300 as double), (a, c) -> least(a, c))"
    entropy = f"ln({total}) - {moment} / {total}"
    # Repeats of the rarest source when the commonest is passed once: (top / low)^(1 - e).
    repeats = f"pow({top} / {low}, 1 - e)"
    if target.budget is not None:
        repeats = f"{target.budget} * pow({low} / {top}, e) / ({total}) / {low}"

    def bisect(good_is_low: bool, good: str) -> str:
        test = f"element_at(transform(array((s.lo + s.hi) / 2), e -> {good}), 1)"
        up = "named_struct('lo', (s.lo + s.hi) / 2, 'hi', s.hi)"
        down = "named_struct('lo', s.lo, 'hi', (s.lo + s.hi) / 2)"
        first, second = (up, down) if good_is_low else (down, up)
        return (
            f"aggregate(sequence(1, {STEPS}), "
            "named_struct('lo', cast(0 as double), 'hi', cast(1 as double)), "
            f"(s, i) -> if({test}, {first}, {second}), s -> {'s.lo' if good_is_low else 's.hi'})"
        )

    wanted = f"{target.entropy_share} * ln(size(counts))"
    flat_enough = f"{entropy} >= {wanted}"
    at_one = f"element_at(transform(array(cast(1 as double)), e -> {flat_enough}), 1)"
    by_entropy = f"if({at_one}, cast(1 as double), {bisect(True, flat_enough)})"
    seldom = f"{repeats} <= {target.most_repeats}"
    at_zero = f"element_at(transform(array(cast(0 as double)), e -> {seldom}), 1)"
    by_repeats = f"if({at_zero}, cast(0 as double), {bisect(False, seldom)})"
    counts = sources.agg(F.sort_array(F.collect_list(F.col("tokens").cast("double"))).alias("counts"))
    exponent = counts.select(
        F.greatest(F.expr(by_entropy), F.expr(by_repeats)).alias("exponent"),
        F.expr(top).alias("top"), "counts",
    )
    exponent = exponent.select(
        "exponent", "top",
        F.expr(f"element_at(transform(array(exponent), e -> {total}), 1)").alias("total"),
    )
    share = F.pow(F.col("tokens") / F.col("top"), F.col("exponent"))
    budget = F.lit(target.budget) if target.budget is not None else F.col("top") * F.col("total")
    return (
        sources.join(F.broadcast(exponent))  # one row
        .withColumn("weight", share / F.col("total"))
        .withColumn("budget", F.round(F.col("weight") * budget).cast("long"))
        .withColumn("repeats", F.col("budget") / F.col("tokens"))
        .select("source", "tokens", "exponent", "weight", "budget", "repeats")
    )


def mix(docs: DataFrame, target: Target, staging: common.Staging) -> tuple[DataFrame, DataFrame]:
    """Documents of the mixture, and the weights of the sources.

    ``docs`` needs ``doc_id``, ``text`` and ``source``. The result has its columns and then
    ``__pass`` (from 0), ``__tokens``, ``__block``, ``__place`` (the block's place in the
    pass over its source) and ``__order`` (the place in the permuted block), with more
    underscores where the input has such a column; a document occurs once for every pass
    that takes it. A null source is a source of its own. Repeated rows are documents of their own; which of two equal
    rows is taken by a partial pass makes no difference. An empty table gives no rows. A
    document is taken by a partial pass if it begins below the budget, so a source exceeds
    its budget by less than one document.
    """
    carried = [f"__{n}" if c.startswith("__") else c for n, c in enumerate(docs.columns)]
    hashed = docs.toDF(*carried).withColumns({
        "__tokens": tokens_of(F.col("text")),
        "__source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
    })
    per_source = hashed.groupBy(F.col("__source").alias("source")).agg(
        F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    per_source = staging.stage(per_source, "sources")
    weights = source_weights(per_source.select("source", "tokens"), target)
    plan = weights.join(per_source.drop("tokens"), "source").withColumns({
        "blocks": F.ceil(F.col("rows") / target.block_rows),
        "whole": F.floor(F.col("budget") / F.col("tokens")),
    })
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = staging.stage(plan, "plan")
    sources = plan.count()
    lookup = plan.select(
        F.col("source").alias("__source"),
        *[F.col(c).alias(f"__{c}") for c in ("blocks", "whole", "rest")],
    )
    if sources <= MOST_BROADCAST:
        lookup = F.broadcast(lookup)
    any_pass = (F.col("__whole") > 0) | (F.col("__rest") > 0)
    last = F.col("__whole") - F.when(F.col("__rest") > 0, 0).otherwise(1)
    passes = F.when(any_pass, F.sequence(F.lit(0).cast("long"), last))
    rows = hashed.join(lookup, "__source").withColumn("__pass", F.explode(passes))
    rows = rows.withColumns({
        "__block": F.pmod(
            F.xxhash64(F.lit(target.seed), "doc_id", F.length("text")), F.col("__blocks")
        ),
        "__hash": F.xxhash64(F.lit(target.seed), "__pass", "doc_id", "text"),
    })
    rows = rows.withColumn(
        "__place", F.xxhash64(F.lit(target.seed), "__pass", "__source", "__block")
    )
    cut = F.col("__pass") == F.col("__whole")
    sizes = rows.where(cut).groupBy("__source", "__block", "__place").agg(
        F.sum("__tokens").alias("block_tokens"), F.first("__rest").alias("rest")
    )
    before = W.partitionBy("__source").orderBy("__place", "__block").rowsBetween(
        W.unboundedPreceding, -1
    )
    begins = sizes.withColumn("begin", F.coalesce(F.sum("block_tokens").over(before), F.lit(0)))
    begins = begins.select("__source", "__block", (F.col("rest") - F.col("begin")).alias("__room"))
    begins = begins.where("__room > 0")
    whole = rows.where(~cut)
    partial = rows.where(cut).join(begins, ["__source", "__block"])
    in_block = W.partitionBy("__source", "__block").orderBy("__hash", "doc_id").rowsBetween(
        W.unboundedPreceding, -1
    )
    partial = partial.withColumn("__begin", F.coalesce(F.sum("__tokens").over(in_block), F.lit(0)))
    partial = partial.where(F.col("__begin") < F.col("__room")).drop("__room", "__begin")
    names = [F.col(f"`{now}`").alias(c) for now, c in zip(carried, docs.columns, strict=True)]
    added = {"__pass": "__pass", "__tokens": "__tokens", "__block": "__block", "__place": "__place",
             "__order": "__hash"}
    kept = [F.col(now).alias(common.fresh(name, docs)) for name, now in added.items()]
    taken = whole.select(*names, *kept).unionByName(partial.select(*names, *kept))
    return taken, weights


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the mixture with its pass over the source and its place."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken, weights = mix(docs, Target(), common.Staging(spark))
    weights = weights.select(
        F.when(F.col("source") != "", F.expr("substr(source, 2)")).alias("name"), "weight"
    )
    return taken.join(weights, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "source", F.col("__pass").alias("pass"), F.col("__tokens").alias("tokens"),
        F.col("__block").alias("block"), F.col("__order").alias("place"), "weight",
        F.col("__place").alias("block_place"),
    )
