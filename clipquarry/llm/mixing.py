"""Mixing sources to target weights by Poisson replication.

A source of size ``n`` that shall make up the share ``w`` of a mixture of size ``total`` is repeated
at the mean rate ``total * w / n``. Each document gets its own Poisson number of copies with that mean:
a uniform number made from a hash of the seed, the id and the text is inverted through the distribution
function. Copies are exploded and dealt out over all partitions by a hash, in whose order they are
sorted there.

Only DataFrame functions are used. Rates are one row per source, summed map-side first, so that a source
with a third of all rows costs one row per task; they are broadcast only after they were counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import fresh, small_side, store

UNIFORM_DIGITS = 13  # hex digits of a hash: 52 bits, exact in a double
MAX_RATE = 500.0  # of one inversion; larger means are split into equal parts and summed
TAIL = 30  # entries of a distribution beyond twelve deviations above its mean


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of ``key``."""
    digits = F.substring(F.md5(key), 1, UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**UNIFORM_DIGITS))


def _cumulative(rate: Column) -> Column:
    """P(N <= k) for k from 0 until nothing is left, as an array."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + TAIL).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.array_append(acc["c"], F.element_at(acc["c"], -1) + p).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["c"])


def source_rates(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    total: float | None = None,
    temperature: float = 0.5,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per source: ``source``, ``size`` in characters, ``rate``, and the number of ``parts``
    with their ``cumulative`` distribution. ``weights`` (``source``, ``weight``) are relative targets; a
    source it does not name, or names with null, zero or a negative weight, gets rate 0. Several weights
    of one source are summed. Without ``weights`` they are ``size ** temperature``. ``total`` defaults to the
    size of all documents. A source without a character has rate 0: copies of nothing add nothing."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0).cast("long")).alias("size")
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").alias("weight"))
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    usable = (F.col("size") > 0) & (F.col("weight") > 0)
    weighted = store(
        weighted.withColumn("weight", F.when(usable, F.col("weight").cast("double")).otherwise(0.0)),
        "source_sizes",
    )
    sums = weighted.agg(F.sum("weight").alias("w"), F.sum("size").alias("n")).first()
    budget, over = float(total if total is not None else sums["n"] or 0), float(sums["w"] or 0)
    rate = F.when(F.col("weight") > 0, F.lit(budget) * F.col("weight") / F.lit(over or 1.0) / F.col("size"))
    return (
        weighted.select("source", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))
        .withColumn("parts", F.greatest(F.ceil(F.col("rate") / MAX_RATE), F.lit(1)).cast("int"))
        .withColumn("cumulative", _cumulative(F.col("rate") / F.col("parts")))
    )


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    total: float | None = None,
    temperature: float = 0.5,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """All columns of ``docs`` for each copy, with ``copy`` (from 1) and ``shuffle_key`` (underscores are put
    before these names where ``docs`` has them).

    Null ids, texts and sources are values like any other: null sources form one source. Equal rows get
    equal numbers of copies. Empty texts count nothing towards a source's size but are repeated at its
    rate. An empty table gives an empty one. No row is capped or sampled beyond the draw itself."""
    copy, order = fresh(docs, "copy"), fresh(docs, "shuffle_key")
    of_source, parts, mass = (fresh(docs, n) for n in ("_mix_source", "_mix_parts", "_mix_cumulative"))
    n_name, key_name = fresh(docs, "_mix_n"), fresh(docs, "_mix_key")
    rates = store(source_rates(docs, weights, total=total, temperature=temperature, source=source, text=text), "source_rates")
    rates = small_side(rates.select(F.col("source").alias(of_source), F.col("parts").alias(parts), F.col("cumulative").alias(mass)))
    key = F.concat_ws(
        "|",
        F.lit(str(seed)),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("-")),
        F.coalesce(F.md5(text), F.lit("-")),
    )
    draw = lambda j: F.size(
        F.filter(mass, lambda c: c <= uniform(F.concat_ws("#", F.col(key_name), j.cast("string"))))
    )
    n = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda a, j: a + draw(j))
    counted = (
        docs.withColumn(key_name, F.md5(key))
        .join(rates, F.col(source).eqNullSafe(F.col(of_source)))
        .withColumn(n_name, n)
        .where(F.col(n_name) > 0)
    )
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n_name)))).withColumn(
        order, F.md5(F.concat_ws("@", F.col(key_name), F.col(copy).cast("string")))
    )
    chosen = copies.select(*[F.col(f"`{c}`") for c in docs.columns], copy, order)
    return chosen.repartition(F.col(order)).sortWithinPartitions(order)
