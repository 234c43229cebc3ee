"""Mixing sources to target weights by Poisson replication, then a global shuffle.

A source with n rows and target weight w out of W, in a corpus of N rows, is repeated at the mean rate
``w / W * budget / n`` (budget: rows wanted, N by default). Each row's count inverts the Poisson distribution of
that mean at a uniform number hashed from the seed and the row's id, so a rerun, a lost executor or another
partitioning gives the same counts. Rows are exploded by their count and ordered globally by a second hash.

Defined cases: a null source is a source of its own (it has no name and weight 1 unless given); a source without a
given weight takes ``default_weight``; weight 0 drops it, as asked. Rows with equal ids draw equal counts, null ids too. Texts are
carried as they are, null, empty or very long. An empty table gives an empty table. Extra columns stay, whatever their names;
``copy`` is added and replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_names, checkpointed, fresh, let, unit_uniform

#: Sources up to this many go out as a broadcast table of about 50 bytes and one list a source; more are joined by shuffle.
BROADCAST_SOURCES = 2_000
#: Upper ends of the distribution: mean + 12 deviations + 30 leaves out less than 2**-53, one step of the uniform numbers.
DEVIATIONS, EXTRA = 12, 30
#: Numbers in a block of running sums.
BLOCK = 64


def rates(docs: DataFrame, source: str, weights: Mapping[str | None, float] | None = None, alpha: float = 0.5, default_weight: float = 1.0, budget: float | None = None) -> DataFrame:
    """One row a source: its rows, target weight and mean repetition rate.

    Without weights, a source's weight is its row count to the power alpha (1 keeps the mixture, 0 evens it out).
    """
    sizes = docs.groupBy(docs[source].alias("_source")).agg(F.count("*").alias("_rows"))
    if weights is None:
        weight = F.pow(F.col("_rows").cast("double"), F.lit(alpha))
    else:
        known = [F.when(F.col("_source").eqNullSafe(F.lit(k)), F.lit(float(w))) for k, w in weights.items()]
        weight = F.coalesce(*known, F.lit(float(default_weight)))
    sizes = sizes.withColumn("_weight", weight)
    whole = sizes.agg(F.sum("_weight").alias("_all_weight"), F.sum("_rows").cast("double").alias("_all_rows"))
    wanted = F.col("_all_rows") if budget is None else F.lit(float(budget))
    # The totals are one row, so this join multiplies nothing.
    return sizes.join(F.broadcast(whole), F.lit(True)).select("_source", "_rows", "_weight", F.coalesce(F.col("_weight") / F.col("_all_weight") * wanted / F.col("_rows"), F.lit(0.0)).alias("_rate"))


def running(values: Column, levels: int = 3) -> Column:
    """The sums of a list of numbers up to each of them.

    Spark's aggregate() grows a list by copying it, so it runs over short blocks, then over their sums in the same way: the cost stays in
    proportion to the list's length. values is a column or a lambda's variable, not an expression.
    """
    start = F.struct(F.lit(0.0).alias("now"), F.array().cast("array<double>").alias("list"))
    grow = lambda a, x: F.struct((a["now"] + x).alias("now"), F.concat(a["list"], F.array(a["now"] + x)).alias("list"))
    if levels == 1:
        return F.aggregate(values, start, grow, lambda a: a["list"])
    blocks = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(BLOCK)), lambda k: F.aggregate(F.slice(values, k, F.lit(BLOCK)), start, grow))

    def joined(of: Column) -> Column:
        upto = let(F.transform(of, lambda b: b["now"]), lambda sums: running(sums, levels - 1))
        return F.flatten(F.zip_with(of, upto, lambda b, s: F.transform(b["list"], lambda y: s - b["now"] + y)))

    return let(blocks, joined)


def cumulative(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... as a list, from logarithms, so that no large mean underflows."""
    top = F.ceil(rate + DEVIATIONS * F.sqrt(rate) + EXTRA).cast("int")
    logs = F.transform(F.sequence(F.lit(0), top), lambda k: F.log(F.greatest(k, F.lit(1)).cast("double")))
    terms = lambda sums: F.transform(sums, lambda s, k: F.exp(k * F.log(rate) - rate - s))
    return F.when(rate <= 0, F.array(F.lit(1.0))).otherwise(let(let(let(logs, lambda x: running(x)), terms), lambda x: running(x)))


def count_at(uniform: Column, cdf: Column) -> Column:
    """The smallest k whose cumulative probability exceeds the uniform number."""
    return F.size(F.filter(cdf, lambda p: p <= uniform))


@any_names
def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", seed: int = 42, shuffle: bool = True, **target) -> DataFrame:
    """Each row of docs as often as its draw says, with ``copy`` from 1, in a globally shuffled order.

    The source counts are aggregated before they move, and the documents meet them without a shuffle by source, so a
    hot source stays spread over all tasks.
    """
    docs = docs.drop("copy")
    name, cdf, count = fresh(docs, "_mixed_source", "_cdf", "_times")
    # Cut here, the documents are read twice: for the counts, and for the draws.
    known = checkpointed(rates(docs, source, **target))
    by_source = known.select(F.col("_source").alias(name), cumulative(F.col("_rate")).alias(cdf))
    small = F.broadcast(by_source) if known.count() <= BROADCAST_SOURCES else by_source
    drawn = docs.join(small, docs[source].eqNullSafe(F.col(name)))
    times = drawn.withColumn(count, count_at(unit_uniform(docs[doc_id], seed=seed), F.col(cdf))).where(F.col(count) > 0)
    copies = times.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(count)))).select(*[docs[c] for c in docs.columns], F.col("copy"))
    return shuffled(copies, doc_id, seed) if shuffle else copies


def shuffled(df: DataFrame, doc_id: str, seed: int) -> DataFrame:
    """Rows in the order of a hash of seed, id and copy: a global sort, its ranges balanced by sampling."""
    key = F.xxhash64(F.lit(seed), df[doc_id], df["copy"])
    return df.orderBy(key, df[doc_id], df["copy"])
