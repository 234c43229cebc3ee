r"""Personal data: exact base patterns, and identifiers found by bootstrapped contextual extraction.

Base spans are the leftmost, non-overlapping matches of four patterns, filtered by their checks without retries. They
seed the bootstrap: every run without white space that holds a digit, ``@`` or a part of a base span is an instance of a pattern,
the two words to its left. Spark scores the bipartite graph of patterns and values in rounds: a pattern is worth the share of its distinct
values that are sure; seeds are, long values of mixed letters and digits are, and so are, in later rounds, the longer values
of accepted patterns. Patterns with a word in them and enough sure values and score accept their other values as kind ``id``,
whatever their shape. Everything is DataFrame expressions, joins and aggregates; the work grows in proportion to a text's length.

Defined cases: null text is empty and has no spans. Offsets count code points, ends are exclusive. Base spans always
stay; found spans never overlap them. Equal texts get equal spans, so repeated rows, repeated or null ids and ties are
harmless. Very long texts are read whole. Extra columns stay, whatever their names; the result columns' are replaced. An empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_names, SPACE, checkpointed, chunked, fresh, let, lower_ascii, piece, scanned, text_of

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive repeats and the guard at the start only spare the matcher hopeless starts and
#: recursion on very long runs: the matches are those of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATES = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Stands for each code point of a base span while contexts are read; the text's own ones are read as OTHER.
MARK, OTHER = "\ue000", "\ue001"
NOT_SPACE = r"[^\x20\x09-\x0D]"
CANDIDATE = rf"(?<!{NOT_SPACE})[^\x20\x09-\x0D0-9@{MARK}]*+[0-9@{MARK}]{NOT_SPACE}*+"
SPAN = "array<struct<kind:string,start:int,end:int>>"
#: Values that look drawn at random (keys, hashes): letters and digits mixed, and long.
OPAQUE = r"^(?=[^0-9]*+[0-9])(?=[^A-Za-z]*+[A-Za-z])[A-Za-z0-9+/_=-]{24,}+$"
#: Shorter discovered values (counts, years) say little elsewhere: they make no other pattern surer.
SURE_LENGTH = 5


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    n = F.length(number)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(number, n - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(k % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def accepted(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = F.split(match, r"\.")
        return F.forall(part, lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))))
    if kind == "card":
        return let(digits(match), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    return F.lit(True)


def placed(text: Column, pattern: str) -> Column:
    """All matches in order as (match, before, start): before is what lies between the last match and this one."""

    def walk(found: Column) -> Column:
        zipped = F.zip_with(found, F.split(text, pattern, -1), lambda m, p: F.struct(m.alias("match"), p.alias("before")))
        return let(F.filter(zipped, lambda x: x["match"].isNotNull()), started)

    def started(x: Column) -> Column:
        sizes = F.transform(x, lambda y: F.length(y["before"]) + F.length(y["match"]))
        starts = let(sizes, lambda s: scanned(s, lambda a, b: a + b))
        return F.zip_with(x, starts, lambda y, s: F.struct(y["match"].alias("match"), y["before"].alias("before"), (s + F.length(y["before"])).alias("start")))

    none = F.array().cast("array<struct<match:string,before:string,start:int>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(walk(found)))


def spans_of(kind: str, text: Column) -> Column:
    found = F.filter(placed(text, PATTERNS[kind]), lambda x: accepted(kind, x["match"]))
    spans = F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"))).cast(SPAN)
    return spans if GATES[kind] is None else F.when(F.contains(text, F.lit(GATES[kind])), spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """All base spans of a text, by kind as listed, then by start."""
    return F.concat(*[spans_of(k, text) for k in KINDS])


def rewritten(text: Column, spans: Column, label) -> Column:
    """The text with each of the sorted spans replaced by label(span, first, end of all spans before)."""

    def walk(chunks: Column, before: Column) -> Column:
        gap = lambda x, i: piece(chunks, before[i], x["start"] - before[i])
        parts = F.transform(spans, lambda x, i: F.concat(gap(x, i), label(x, before[i])))
        last = F.greatest(F.element_at(before, F.lit(-1)), F.element_at(spans, F.lit(-1))["end"])
        return F.concat(F.array_join(parts, ""), piece(chunks, last, F.length(text) - last))

    ends = F.transform(spans, lambda x: x["end"])
    return let(chunked(text), lambda chunks: let(let(ends, lambda e: scanned(e, F.greatest)), lambda before: walk(chunks, before)))


def in_order(spans: Column) -> Column:
    """By start, of equal starts the longest first."""
    return F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("longest"), x["end"].alias("end"), x["kind"].alias("kind"))))


def marked(text: Column, base: Column) -> Column:
    """The text with every code point of a base span written as MARK, and with no other MARK."""
    hide = lambda x, before: F.repeat(F.lit(MARK), F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], before)))
    plain = F.translate(text, MARK, OTHER)
    return F.when(F.size(base) == 0, plain).otherwise(let(plain, lambda t: let(in_order(base), lambda s: rewritten(t, s, hide))))


def last_words(text: Column) -> Column:
    """Up to two."""
    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    return let(words, lambda w: F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), F.lit(2)))


def tokens(text: Column, base: Column) -> Column:
    """Instances: context (the two words to the left), value, place, seed, sure.

    Every run without white space that holds a digit, ``@`` or a part of a base span is one (base spans are read as one
    mark each, so a span with spaces in it is one run); it is a seed if it holds such a part. A value without the shape of any
    base kind that looks drawn at random is sure like a seed, but no span by itself.
    """

    def instances(found: Column) -> Column:
        short = F.transform(found, lambda x: F.struct(x["match"].alias("match"), x["start"].alias("start"), last_words(x["before"]).alias("words")))
        return let(short, lambda x: F.transform(x, lambda y, i: instance(x, y, i)))

    def instance(x: Column, y: Column, i: Column) -> Column:
        none = F.array().cast("array<string>")
        # A run ends at white space, so the words before this run are: those of the gap, the run before, those of its gap, ...
        third = F.when(i > 1, F.array(F.get(x, i - 2)["match"])).otherwise(none)
        second = F.when(i > 0, F.concat(F.get(x, i - 1)["words"], F.array(F.get(x, i - 1)["match"]))).otherwise(none)
        left = F.concat(F.array(F.lit("^"), F.lit("^")), third, second, y["words"])
        context = F.regexp_replace(F.array_join(let(left, lambda w: F.slice(w, F.lit(-2), F.lit(2))), " "), MARK + "+", MARK)
        lead = F.length(F.regexp_extract(y["match"], rf"^[^\p{{L}}\p{{N}}+{MARK}]*+", 0))
        value = F.regexp_extract(y["match"], rf"^[^\p{{L}}\p{{N}}+{MARK}]*+(.*[\p{{L}}\p{{N}}{MARK}])", 1)
        parts = F.struct(lower_ascii(context).alias("context"), value.alias("value"), (y["start"] + lead).alias("start"), F.contains(y["match"], F.lit(MARK)).alias("seed"))
        return let(parts, lambda p: F.struct(p["context"].alias("context"), p["value"].alias("value"), p["start"].alias("start"), (p["start"] + F.length(p["value"])).alias("end"), p["seed"].alias("seed"), (p["seed"] | F.rlike(p["value"], F.lit(OPAQUE))).alias("sure")))

    def read(chunks: Column, found: Column) -> Column:
        """A seed's value is what the text says where it is marked."""
        said = lambda x: F.when(x["seed"], piece(chunks, x["start"], x["end"] - x["start"])).otherwise(x["value"])
        return F.transform(found, lambda x: F.struct(x["context"].alias("context"), said(x).alias("value"), *[x[k].alias(k) for k in ("start", "end", "seed", "sure")]))

    found = let(marked(text, base), lambda m: let(placed(m, CANDIDATE), instances))
    return let(chunked(text), lambda chunks: read(chunks, F.filter(found, lambda x: x["value"] != "")))


def good_patterns(edges: DataFrame, rounds: int = 3, min_score: float = 0.8, min_seeds: int = 3) -> DataFrame:
    """edges (pattern, value, seed) -> pattern: those accepted in the last round.

    Round by round, a pattern's score is the share of its distinct values that are sure. Seeds are sure; after a round so
    are the values of SURE_LENGTH code points or more in accepted patterns, so that patterns which no seed has can follow.
    Aggregates combine on the map side, so a value or a pattern that holds most rows is summed before it moves.
    """
    graph = checkpointed(edges.groupBy("pattern", "value").agg(F.max(F.col("seed").cast("double")).alias("seed")))
    rated, good = graph, None
    for k in range(rounds):
        scores = rated.groupBy("pattern").agg(F.avg("seed").alias("score"), F.sum("seed").alias("seeds"))
        good = checkpointed(scores.where((F.col("score") >= min_score) & (F.col("seeds") >= min_seeds) & F.rlike("pattern", F.lit(r"\p{L}"))).select("pattern"))
        if k + 1 < rounds:
            sure = graph.where((F.col("seed") == 0) & (F.length("value") >= SURE_LENGTH)).join(good, "pattern").select("value").distinct()
            sure = checkpointed(sure)
            rated = graph.join(sure.withColumn("sure", F.lit(1.0)), "value", "left").withColumn("seed", F.greatest("seed", F.coalesce("sure", F.lit(0.0))))
    return good


def key(text: Column) -> Column:
    """Names a text: equal texts, equal keys. Null counts as empty."""
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"), F.length(text).alias("n"))


def discovered(instances: DataFrame, rounds: int = 3, min_score: float = 0.8, min_seeds: int = 3) -> DataFrame:
    """instances (_key, tokens) -> _key, found: the spans of kind id that accepted patterns find, a row a text with any."""
    edges = instances.select("_key", F.explode("tokens").alias("x")).select("_key", "x.*").withColumnRenamed("context", "pattern")
    good = good_patterns(edges.select("pattern", lower_ascii(F.col("value")).alias("value"), F.col("sure").alias("seed")), rounds, min_score, min_seeds)
    hits = edges.where("not seed").join(good, "pattern").select("_key", F.struct(F.lit("id").alias("kind"), F.col("start"), F.col("end")).alias("span")).distinct()
    return hits.groupBy("_key").agg(F.sort_array(F.collect_list("span")).cast(SPAN).alias("found"))


@any_names
def annotate(docs: DataFrame, text: str = "text", base: str = "base_spans", found_as: str = "found_spans", **bootstrap) -> DataFrame:
    """docs with base and found spans (arrays of kind, start, end) in two columns; columns of their names are replaced."""
    docs = docs.drop(base, found_as)
    own, other = fresh(docs, "_key", "_found_key")
    whole = text_of(docs, text)
    # The filter reads the text alone: one on the spans would move below and find them anew for every token.
    asked = docs.where(F.rlike(whole, F.lit("[0-9@]")))
    instances = asked.select(key(whole).alias("_key"), let(base_spans(whole), lambda b: tokens(whole, b)).alias("tokens"))
    found = discovered(checkpointed(instances), **bootstrap).select(F.col("_key").alias(other), F.col("found").alias(found_as))
    joined = docs.withColumns({own: key(whole), base: base_spans(whole)}).join(found, F.col(own) == F.col(other), "left")
    return joined.drop(own, other).withColumn(found_as, F.coalesce(found_as, F.array().cast(SPAN)))


@any_names
def redact(docs: DataFrame, text: str = "text", **bootstrap) -> DataFrame:
    """docs with each base or found span of text replaced by ``[KIND]``; texts without spans, null too, stay as they are.

    Spans of two kinds that overlap are replaced as one, under the kind that starts first, or of equal starts the longer one.
    """
    base, found = fresh(docs, "_base", "_found")
    spans = annotate(docs, text, base, found, **bootstrap)
    c = spans[text]
    name = lambda x, before: F.when(x["start"] < before, "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
    masked = let(in_order(F.concat(base, found)), lambda s: F.when(F.size(s) == 0, c).otherwise(rewritten(c, s, name)))
    return spans.withColumn(text, masked).drop(base, found)
