"""How filters interact: what every filter removes at every place of every order, from one pass over the documents.

A document is reduced to a mask of the filters that it fails. Documents are counted by part, mask and label first, on the map
side too, so a part that holds most rows costs no more than another. Then each mask stands for one wide integer with a field for each
outcome (kept, removed, redundant) at each step of each order: 3 x 120 x 5 fields for five filters. A part's integers are added
up, weighted by their counts, and the fields are read back; a field has 64 bits, more than any count, so none runs into the next.

The last filter, repetition, is not a property of one text: a document fails it if any smaller doc_id has its text, in
any part, removed or not. Equal texts meet by their SHA-256: they are first counted by part and label, so a text with very many copies is
a few rows by then.

Defined cases: null text is empty, null part is the empty string. Rows of null id repeat nobody and are repeated by nobody; rows of
equal id and text are no copies of each other. A document is good (toxic) if any of its labels says so; one without label
is neither. Texts are read whole; extra columns are left out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, let

#: Bits of a counter: counts are below 2^63.
FIELD = 64
OUTCOMES = ("kept", "removed", "redundant")
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column) -> dict[str, Column]:
    """The filters on one text: few words, few different words, many capitals, symbols."""
    words = F.filter(F.split(text, f"{SPACE}+", -1), lambda w: w != "")
    counts = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("different")))
    many = let(counts, lambda c: F.when(c["n"] < 200, 1).otherwise(0) + F.when(F.lit(100).cast("long") * c["different"] < F.lit(50).cast("long") * c["n"], 2).otherwise(0))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"AB": many, "C": F.lit(100).cast("long") * capitals > F.lit(3).cast("long") * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, mask (bit k: fails filter k of ABCDE), good, toxic, n."""
    text = F.coalesce(docs["text"], F.lit(""))
    fails = failures(text)
    mask = fails["AB"] + F.when(fails["C"], 4).otherwise(0) + F.when(fails["D"], 8).otherwise(0)
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs[part], F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("same"))
    marks = labels.groupBy(labels["doc_id"].alias("_id")).agg(F.max(labels["quality"] == 1).alias("good"), F.max(labels["toxic"] == 1).alias("toxic"))
    rows = rows.join(marks, rows["doc_id"] == marks["_id"], "left").select("doc_id", "part", "mask", "same", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    # The join has dealt rows by id, so this count moves none.
    once = rows.groupBy("same", "doc_id", "part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    has_id = F.col("doc_id").isNotNull()
    kinds = once.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first"), F.coalesce(F.sum(F.when(~has_id, F.col("n"))), F.lit(0)).alias("no_id")
    )
    least = F.min("first.doc_id").over(Window.partitionBy("same"))
    kinds = kinds.withColumn("least", least).withColumn("single", F.col("no_id") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0))
    two = F.array(F.struct(F.col("mask"), F.col("single").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("single")).alias("n")))
    return kinds.select("part", "good", "toxic", F.inline(two)).where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def packed(names: str) -> tuple[list[str], list[int]]:
    """(all orders of the filters, by mask the integer with a 1 in each field whose outcome it has)."""
    orders = ["".join(o) for o in permutations(names)]
    out = []
    for mask in range(1 << len(names)):
        fields = np.zeros((len(OUTCOMES), len(orders), len(names)), "<u8")
        for o, order in enumerate(orders):
            gone = False
            for s, name in enumerate(order):
                fails = bool(mask >> names.index(name) & 1)
                fields[1, o, s], fields[2, o, s] = fails and not gone, fails and gone
                gone = gone or fails
                fields[0, o, s] = not gone
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return orders, out


def unpacked(total: int, n_orders: int, n_steps: int) -> np.ndarray:
    shape = (len(OUTCOMES), n_orders, n_steps)
    return np.frombuffer(total.to_bytes(int(np.prod(shape)) * FIELD // 8, "little"), "<u8").reshape(shape).astype(np.int64)


def report(part: str, counts: Sequence[tuple[int, bool, bool, int]], names: str, orders: list[str], table: list[int]) -> pd.DataFrame:
    """A part's rows from its counts by mask and label: at most 128 of them."""
    every = good = toxic = 0
    alone = dict.fromkeys(names, 0)
    for mask, is_good, is_toxic, n in counts:
        wide = n * table[mask]
        every, good, toxic = every + wide, good + is_good * wide, toxic + is_toxic * wide
        if mask and mask & (mask - 1) == 0:
            alone[names[mask.bit_length() - 1]] += n
    k = len(names)
    kept, removed, redundant = unpacked(every, len(orders), k)
    place = np.array([[names.index(x) for x in o] for o in orders])
    shares = np.array([removed[place == f].sum() for f in range(k)])
    lost = [unpacked(x, len(orders), k)[1].ravel() for x in (good, toxic)]
    return pd.DataFrame({
        "part": part, "filter_order": np.repeat(orders, k), "step": np.tile(np.arange(1, k + 1), len(orders)), "kept": kept.ravel(), "removed": removed.ravel(), "redundant": redundant.ravel(),
        "unique_fails": np.array([alone[x] for x in names])[place].ravel(), "good_lost": lost[0], "toxic_lost": lost[1], "shapley": shares[place].ravel(),
    })


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row a part, order of the filters and step."""
    names = "ABCDE"
    orders, table = packed(names)
    wide = docs.sparkSession.sparkContext.broadcast((orders, table))

    def one(counts: pd.DataFrame) -> pd.DataFrame:
        rows = zip(counts["mask"].tolist(), counts["good"].tolist(), counts["toxic"].tolist(), counts["n"].tolist())
        return report(counts["part"].iloc[0], list(rows), names, *wide.value)

    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
    return masks(docs, labels, part).groupBy("part").applyInPandas(one, schema)
