"""Quality rules: fixed text statistics, then a decision list learned by sequential covering.

The list is an ordered series of threshold conjunctions ("share of symbols > 0.04 and words <= 90: reject"). Each
conjunction is grown on two thirds of the labelled statistics, one literal at a time by information gain, pruned on the
remaining third, kept if precise enough there, and the rows that it covers are set aside before the next one grows.
The learner only ever sees histograms: counts by label of each statistic's bins, computed by Spark.

Defined cases: null text counts as empty (no words, fails the base rule). Without labelled rows of both kinds the list
is empty and the base rule alone decides. Ties between literals go to the first by name, direction and cut. Very long texts are
read whole. Repeated rows get equal verdicts. Extra columns stay, whatever their names; the result columns' are replaced. An empty
table gives an empty table.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_names, LOWER, SPACE, SPACE_CHARS, UPPER, checkpointed, fresh, let, text_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: At most so many labelled documents are learned from: those with the smallest hash of their id.
MAX_LABELLED = 20_000
#: Cut points tried for each statistic: that many quantiles of the labelled rows.
CUTS = 24
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEARNED = ("symbol_share", "word_length", "distinct_share", "upper_share", "digit_share", "mark_share", "short_share", "dup_line_share", "repeat_share", "words")


def words_of(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def repeat_words(words: Column) -> Column:
    """Words that lie in 5-word windows found twice or more in the text, the first find included.

    Windows are compared by a 64-bit hash. Texts with none twice stop after one hash set; else the hashes are sorted with
    their places and covered words are counted from the sorted places.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[words[i + k] for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(placed, lambda s: sum_of(F.sort_array(twice(s))))

    def twice(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda x, j: ((j > 0) & (x["h"] == F.try_element_at(s, F.greatest(j, F.lit(1)))["h"])) | ((j < last) & (x["h"] == F.try_element_at(s, j + 2)["h"]))
        return F.transform(F.filter(s, same), lambda x: x["i"])

    def sum_of(places: Column) -> Column:
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("sum"))
        return F.aggregate(places, zero, lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), p - a["last"])).alias("sum")), lambda a: a["sum"])

    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))
    return F.when(n < WINDOW, F.lit(0).cast("bigint")).otherwise(counted)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts and the shares that the list is learned on (columns BASE and LEARNED)."""
    docs = docs.drop(*BASE, *LEARNED)
    inner = ("words", "lines", "space", "upper", "lower", "digits", "marks", "distinct", "n_lines")
    own = dict(zip(inner, fresh(docs, *[f"_{k}" for k in inner])))
    whole = text_of(docs, text)
    without = lambda chars: (F.length(whole) - F.length(F.translate(whole, chars, ""))).cast("bigint")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != "")
    step = docs.withColumns({
        own["words"]: words_of(whole), own["lines"]: lines,
        own["space"]: without(SPACE_CHARS), "n_symbols": without(SYMBOLS),
        own["upper"]: without(UPPER), own["lower"]: without(LOWER), own["digits"]: without("0123456789"), own["marks"]: without("!?|"),
    })
    step = step.withColumns({
        "n_words": F.size(own["words"]).cast("bigint"),
        "word_chars": F.length(whole).cast("bigint") - F.col(own["space"]),
        "n_dup_lines": (F.size(own["lines"]) - F.size(F.array_distinct(own["lines"]))).cast("bigint"),
        "n_repeat_words": let(step[own["words"]], repeat_words),
        own["distinct"]: F.size(F.array_distinct(own["words"])), own["n_lines"]: F.size(own["lines"]),
    })
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    short = F.col("n_words") / (F.col(own["n_lines"]) + 1)
    made = {
        "symbol_share": per("n_symbols", "word_chars"), "word_length": per("word_chars", "n_words"), "distinct_share": per(own["distinct"], "n_words"), "upper_share": F.when(F.col(own["upper"]) + F.col(own["lower"]) > 0, F.col(own["upper"]) / (F.col(own["upper"]) + F.col(own["lower"]))).otherwise(0.0),
        "digit_share": per(own["digits"], "word_chars"), "mark_share": per(own["marks"], "word_chars"), "short_share": short, "dup_line_share": per("n_dup_lines", own["n_lines"]), "repeat_share": per("n_repeat_words", "n_words"), "words": F.col("n_words").cast("double"),
    }
    return step.withColumns(made).drop(*own.values())


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


class Literal(NamedTuple):
    name: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.name) > self.cut if self.above else F.col(self.name) <= self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


class Clause(NamedTuple):
    """Rejects what all its literals cover. hits and errors: counts on the rows held out for pruning."""

    literals: tuple[Literal, ...]
    hits: int
    errors: int

    def column(self) -> Column:
        return conjunction(self.literals)

    def __str__(self) -> str:
        return " and ".join(map(str, self.literals)) + f": reject ({self.hits} right, {self.errors} wrong)"


def conjunction(literals) -> Column:
    out = F.lit(True)
    for x in literals:
        out = out & x.column()
    return out


def rejected(clauses) -> Column:
    """The ordered list as one conditional expression: the number of the first clause that fires, 0 if none does."""
    out = F.lit(0)
    for k, c in reversed(list(enumerate(clauses, 1))):
        out = F.when(c.column(), k).otherwise(out)
    return out


def histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Literal, tuple[int, int]]:
    """(low quality, good) rows that each literal covers: one pass, at most statistics x (cuts + 1) rows back."""
    below = lambda k: lambda cut: cut < F.col(k)
    bins = F.array(*[F.struct(F.lit(k).alias("name"), F.size(F.filter(F.array(*map(F.lit, v)), below(k))).alias("bin")) for k, v in cuts.items()])
    counts = rows.select(F.explode(bins).alias("x"), "bad").groupBy("x.name", "x.bin").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect()
    of = {(r["name"], r["bin"]): (r["bad"], r["good"]) for r in counts}
    out: dict[Literal, tuple[int, int]] = {}
    for k, v in cuts.items():
        column = [of.get((k, b), (0, 0)) for b in range(len(v) + 1)]
        for b, cut in enumerate(v):
            out[Literal(k, False, cut)] = tuple(sum(x[i] for x in column[: b + 1]) for i in (0, 1))
            out[Literal(k, True, cut)] = tuple(sum(x[i] for x in column[b + 1 :]) for i in (0, 1))
    return out


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    bits = lambda p, n: math.log2(p / (p + n)) if p else -99.0
    return bad * (bits(bad, good) - bits(all_bad, all_good))


def learn(labelled: DataFrame, quality: str = "quality", key: str = "doc_id", max_clauses: int = 8, max_literals: int = 3, min_hits: int = 5, min_precision: float = 0.95, grow_precision: float = 0.98) -> list[Clause]:
    """The decision list from rows with the statistics and a 0/1 quality (null: not used).

    A clause that is right in fewer than ``min_precision`` of the held-out rows it covers is not taken, so clean
    documents stay. Ties between literals go to the first by name, direction and cut.
    """
    rows = labelled.where(labelled[quality].isNotNull() & ~base_failed()).select(*LEARNED, (1 - F.col(quality)).cast("int").alias("bad"), (F.pmod(F.xxhash64(F.lit("prune"), key), F.lit(3)) == 0).alias("held"))
    rows = checkpointed(rows)
    quantiles = rows.agg(*[F.percentile_approx(k, F.array(*[F.lit((i + 0.5) / CUTS) for i in range(CUTS)]), F.lit(1000)).alias(k) for k in LEARNED], *[F.percentile_approx(F.when(F.col("bad") == 1, F.col(k)), F.array(*[F.lit((i + 0.5) / CUTS) for i in range(CUTS)]), F.lit(1000)).alias(f"bad_{k}") for k in LEARNED]).first()
    cuts = {k: sorted({*(quantiles[k] or []), *(quantiles[f"bad_{k}"] or [])}) for k in LEARNED}
    cuts = {k: v for k, v in cuts.items() if v}
    if not cuts:
        return []
    grow, held, clauses = rows.where("not held"), rows.where("held"), []
    while len(clauses) < max_clauses:
        left = F.lit(True) if not clauses else rejected(clauses) == 0
        literals: list[Literal] = []
        while len(literals) < max_literals:
            covered = histogram(grow.where(left & conjunction(literals)), cuts)
            totals = [covered[Literal(k, up, v[0])] for k, v in list(cuts.items())[:1] for up in (False, True)]
            bad, good = (sum(x[i] for x in totals) for i in (0, 1))
            if bad < min_hits or (literals and bad >= grow_precision * (bad + good)):
                break
            best = max(covered, key=lambda x: (_gain(*covered[x], bad, good) if covered[x][0] >= min_hits else -1e9, x.name, not x.above, -x.cut))
            if covered[best][0] < min_hits or _gain(*covered[best], bad, good) <= 0:
                break
            literals.append(best)
        if not literals:
            break
        tests = [literals[:k] for k in range(1, len(literals) + 1)]
        counts = held.where(left).agg(*[F.coalesce(F.sum(F.when(conjunction(t), v)), F.lit(0)).alias(f"{n}{k}") for k, t in enumerate(tests) for n, v in (("bad", F.col("bad")), ("good", 1 - F.col("bad")))]).first()
        value = lambda k: (counts[f"bad{k}"] - counts[f"good{k}"]) / max(1, counts[f"bad{k}"] + counts[f"good{k}"])  # noqa: E731, B023
        k = max(range(len(tests)), key=lambda k: (value(k), counts[f"bad{k}"], -k))
        clause = Clause(tuple(tests[k]), counts[f"bad{k}"], counts[f"good{k}"])
        if clause.hits < 2 or clause.hits < min_precision * (clause.hits + clause.errors):
            break
        clauses.append(clause)
    return clauses


def learn_from(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", max_labelled: int = MAX_LABELLED) -> list[Clause]:
    """The list from documents that labels names; the sample of labels is bounded, a few bytes a row, and broadcast."""
    ids = labels.where(labels[quality].isNotNull()).groupBy(labels[doc_id].alias("_id")).agg(F.min(quality).alias("_quality"))
    sample = ids.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    known = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).drop("_id")
    # Cut here, or filters on the statistics move below the join, which then computes them for all documents.
    return learn(statistics(checkpointed(known), "text"), "_quality", "doc_id")


@any_names
def judge(docs: DataFrame, clauses: list[Clause], text: str = "text") -> DataFrame:
    """docs with the statistics, base_failed, clause (number of the clause that fired, 0: none) and kept."""
    out = statistics(docs.drop("base_failed", "clause", "kept"), text)
    out = out.withColumns({"base_failed": base_failed(), "clause": rejected(clauses)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("clause") == 0))
