"""Masked pseudo-likelihood scores: a bidirectional window network predicts every token from both sides.

The network sees RADIUS words on each side of a masked word. Their embeddings, one table a place, are summed and passed through
tanh; a softmax over that gives the word's class; the class's own vector is added, and a second softmax gives the word's place
in the class. So a prediction costs about 2 * sqrt(V) products instead of V, and a batch is a few matrix products.

Texts are encoded once: word ids for the network, hashes of the words that it does not know. Training is data-parallel numpy:
lines of ids are collapsed to different ones with their counts and dealt by their hash over shards whose number follows from the
corpus's tokens alone; in each round every shard trains its own copy on its positions (each position in one of the ROUNDS), and
Spark averages the copies part by part in a tree. Scores therefore depend neither on partitioning nor on the order of rows.
Words outside the network's vocabulary share its hashed ids; an id's probability is split among its words by their counts in
the corpus, which stay a table and are joined to the tokens, so every word has its own conditional probability however many
there are. A document's score is the sum of its tokens' conditional log-probabilities.

Defined cases: words are runs without space and bytes 9 to 13, in lower case. Null or blank text has no tokens, log_prob 0 and a
null mean. A word that the counts lack has the share of one more occurrence of its id. Ties in the vocabulary go by word. Long
texts are trained on and scored whole, in lines of CHUNK tokens with their neighbours on both sides. Repeated rows count as often
as they occur and get equal scores. Extra columns stay, whatever their names; result columns' are replaced. An empty corpus gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import any_names, checkpointed, forget, fresh, scratch, tidy

RADIUS, HIDDEN = 2, 16
CLASSES = 64
VOCABULARY = CLASSES * CLASSES
#: The last BUCKETS ids are shared by all words outside the network's vocabulary, by hash; their own counts tell them apart.
BUCKETS, BUCKET_BITS = 1024, 10
WORDS = VOCABULARY - BUCKETS
#: The id on either side of a document.
EDGE = VOCABULARY
CHUNK = 1 << 13
#: Each position is trained on in one of so many rounds; copies are averaged after each.
ROUNDS = 2
BATCH, RATE = 4096, 0.15
#: A shard holds about so many tokens; it is one group of one task.
SHARD_TOKENS = 1 << 21
#: Copies averaged by one task, and the parts that weights are cut into for that.
FAN_IN, PARTS = 64, 16
#: Rows encoded or scored at once.
ROWS = 1024
#: Log-shares are summed in these units, as whole numbers, so that no order of adding shows.
MICRO = 1_000_000


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(words of each text, all words in order) of these texts in lower case; nulls have none."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
    return np.bincount(owner, minlength=len(lists)), words.filter(real)


def words_of(text: str | None) -> list[str]:
    return split_words(pa.array([text], pa.string()))[1].to_pylist()


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n over all documents; each task adds up its own words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                found = pc.value_counts(split_words(batch.column(0).slice(a, ROWS))[1])
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])
        pa.default_memory_pool().release_unused()

    return docs.select(docs[text].cast("string").alias("text")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counted: DataFrame) -> tuple[list[str], list[int], int]:
    """(the WORDS most frequent words, their counts, all tokens) of counts(); ties by word. Bounded by WORDS."""
    top = counted.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    whole = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r["word"] for r in top], [r["n"] for r in top], whole


class Network:
    """Weights by name; id i has class i // CLASSES and place i % CLASSES. Rows of hidden values and logits are units, columns examples."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @staticmethod
    def shapes() -> dict[str, tuple[int, ...]]:
        return {"context": (2 * RADIUS, VOCABULARY + 1, HIDDEN), "bias": (HIDDEN,), "classes": (CLASSES, HIDDEN), "class_bias": (CLASSES,), "given": (CLASSES, HIDDEN), "places": (CLASSES, HIDDEN), "place_bias": (CLASSES, CLASSES)}

    @classmethod
    def new(cls, prior: np.ndarray, seed: int = 7) -> Network:
        """Random embeddings, zero outputs: before training it predicts the prior (a probability for each id)."""
        rng, f = np.random.default_rng(seed), np.float32
        w = {k: np.zeros(s, f) for k, s in cls.shapes().items()}
        table = prior.reshape(CLASSES, CLASSES)
        by_class = table.sum(axis=1)
        w["context"] = rng.normal(0, 0.3, w["context"].shape).astype(f)
        w["given"] = rng.normal(0, 0.3, w["given"].shape).astype(f)
        w["class_bias"], w["place_bias"] = np.log(by_class).astype(f), np.log(table / by_class[:, None]).astype(f)
        return cls(w)

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        h = self.w["context"][0].take(sides[0], axis=0)
        for k in range(1, 2 * RADIUS):
            h += self.w["context"][k].take(sides[k], axis=0)
        h = np.ascontiguousarray(h.T)
        h += self.w["bias"][:, None]
        return np.tanh(h, out=h)

    @staticmethod
    def softmax(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Turns the columns of logits into probabilities, in place; returns the log-probability of each column's own row."""
        x -= x.max(axis=0)
        told = x[own, np.arange(own.size)]
        np.exp(x, out=x)
        whole = x.sum(axis=0)
        x /= whole
        return told - np.log(whole)

    def forward(self, sides: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, ...]:
        w, targets = self.w, targets.astype(np.intp)
        of, place = targets // CLASSES, targets % CLASSES
        h = self.hidden(sides)
        p = w["classes"] @ h
        p += w["class_bias"][:, None]
        told = self.softmax(p, of)
        g = h + w["given"].T.take(of, axis=1)
        np.tanh(g, out=g)
        q = w["places"] @ g
        q += w["place_bias"].T.take(of, axis=1)
        told += self.softmax(q, place)
        return told, of, place, h, p, g, q

    def log_prob(self, sides: np.ndarray, targets: np.ndarray) -> np.ndarray:
        return self.forward(sides, targets)[0]

    def step(self, sides: np.ndarray, targets: np.ndarray, weights: np.ndarray, rate: float, sums: dict[str, np.ndarray]) -> None:
        """One step of Adagrad on these examples, each counted by its weight; sums: the squared gradients so far, of every weight."""
        w, n = self.w, targets.size
        _, of, place, h, p, g, q = self.forward(sides, targets)
        share = (weights / weights.sum()).astype(np.float32)
        at = np.arange(n)
        p[of, at] -= 1
        q[place, at] -= 1
        p *= share
        q *= share
        is_class = np.zeros((n, CLASSES), np.float32)
        is_class[at, of] = 1
        back = w["places"].T @ q
        back *= 1 - g * g
        gradients = {"classes": p @ h.T, "class_bias": p.sum(axis=1), "places": q @ g.T, "place_bias": (q @ is_class).T, "given": (back @ is_class).T}
        back += w["classes"].T @ p
        back *= 1 - h * h
        gradients["bias"] = back.sum(axis=1)
        flat, cell = back.T.astype(np.float64).ravel(), np.arange(HIDDEN)
        gradients["context"] = np.stack([np.bincount((side[:, None] * HIDDEN + cell).ravel(), flat, (VOCABULARY + 1) * HIDDEN) for side in sides]).astype(np.float32).reshape(w["context"].shape)
        for k, x in gradients.items():
            sums[k] += x * x
            x *= rate
            x /= np.sqrt(sums[k]) + np.float32(1e-4)
            w[k] -= x

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in self.shapes()])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> Network:
        out, at = {}, 0
        for k, shape in cls.shapes().items():
            n = int(np.prod(shape))
            out[k] = values[at : at + n].astype(np.float32).reshape(shape)
            at += n
        return cls(out)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    """The shared id of words by their hash, xxhash64 as Spark's."""
    return (WORDS + (hashes.view(np.uint64) >> np.uint64(64 - BUCKET_BITS))).astype(np.int64)


def prior_of(ns: list[int], whole: int) -> np.ndarray:
    """Add-one unigram probabilities of the ids, the rest of all tokens shared evenly by the hashed ids."""
    p = np.ones(VOCABULARY)
    p[: len(ns)] += ns
    p[WORDS:] += max(0, whole - sum(ns)) / BUCKETS
    return p / p.sum()


def ids_of(texts: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, ids of all words in order, hashes of all words): words outside ``known`` have an id by their hash, the others hash 0."""
    lengths, words = split_words(texts)
    coded = words.dictionary_encode()
    different = coded.dictionary
    at = pc.fill_null(pc.index_in(different, known), -1).to_numpy()
    rare = np.flatnonzero(at < 0)
    spelled = different.take(pa.array(rare)).cast(pa.large_binary()).to_pylist()
    hashes = np.zeros(at.size, np.uint64)
    hashes[rare] = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in spelled), np.uint64, rare.size)
    ids = np.where(at >= 0, at, bucket_of(hashes))
    places = coded.indices.to_numpy()
    return lengths, ids[places], np.where(at >= 0, np.uint64(0), hashes)[places]


def sides_of(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The words around each place of a padded line, one row a relative place."""
    return np.stack([line[at + k] for k in range(-RADIUS, RADIUS + 1) if k]).astype(np.intp)


def lined(lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one line of all documents' ids with edges on both sides of each, the end of each document in it)."""
    ends = np.cumsum(lengths + 2 * RADIUS)
    line = np.full(int(ends[-1]) if ends.size else 0, EDGE, np.int16)
    line[np.arange(ids.size) + np.repeat(np.arange(lengths.size) * 2 * RADIUS + RADIUS, lengths)] = ids
    return line, ends


def encoded(docs: DataFrame, words: list[str], text: str = "text", keep_text: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """(docs with its tokens as ids and hashes, the names of the columns that hold them). Cuts lineage.

    ids: 16-bit ids with edges on both sides; rare: hashes of the words outside ``words``; row: a number for the row.
    """
    docs = docs.drop("n_tokens", "log_prob", "mean_log_prob")
    names = dict(zip(("ids", "rare", "row", "text"), fresh(docs, "_ids", "_rare", "_row", "_text")))
    kept = [c for c in docs.columns if keep_text or c != text]
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.large_string())
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                lengths, ids, hashes = ids_of(batch.column(len(kept)), known)
                line, ends = lined(lengths, ids)
                lines = pa.Array.from_buffers(pa.large_binary(), lengths.size, [None, pa.py_buffer(np.concatenate([[0], 2 * ends]).astype(np.int64)), pa.py_buffer(line)])
                rare = ids >= WORDS
                owner = np.repeat(np.arange(lengths.size), lengths)[rare]
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=lengths.size))])
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(lengths, pa.int64()), lines.cast(pa.binary()), listed], names=[*kept, "n_tokens", names["ids"], names["rare"]])
        pa.default_memory_pool().release_unused()  # workers are kept for later tasks, which have other needs

    schema = ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"n_tokens bigint, `{names['ids']}` binary, `{names['rare']}` array<bigint>"])
    seen = docs.select(*kept, docs[text].cast("string").alias(names["text"])).mapInArrow(run, schema)
    return checkpointed(seen.withColumn(names["row"], F.monotonically_increasing_id())), names


def shards(seen: DataFrame, names: dict[str, str], tokens: int) -> DataFrame:
    """(line, times, shard): the different lines of at most CHUNK tokens with their neighbours, how often each occurs, where it is trained on.

    A shard's lines lie together, in order, in one partition, so that no round shuffles them again.
    """
    ids = F.col(names["ids"])
    starts = F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / CHUNK).cast("int"))
    lines = seen.where("n_tokens > 0").select(F.explode(F.transform(starts, lambda k: F.substring(ids, k * (2 * CHUNK) + 1, F.lit(2 * (CHUNK + 2 * RADIUS))))).alias("line"))
    n = max(1, -(-tokens // SHARD_TOKENS))
    different = lines.groupBy("line").agg(F.count("*").alias("times")).withColumn("shard", F.pmod(F.xxhash64("line"), F.lit(n)))
    return checkpointed(different.repartition("shard").sortWithinPartitions("shard", "line"))


def positions(n: int, shard: int, round_no: int) -> np.ndarray:
    """Of a shard's n positions, in a random order that is always the same, those that a round trains on; ROUNDS rounds take each once."""
    return np.random.default_rng(shard).permutation(n)[round_no % ROUNDS :: ROUNDS]


def trained(net: Network, lines: list[bytes], times: np.ndarray, shard: int, round_no: int) -> int:
    """Trains net on a shard's lines; returns its positions."""
    sizes = np.array([len(x) // 2 for x in lines], np.int64)
    line = np.frombuffer(b"".join(lines), np.int16)
    inner = sizes - 2 * RADIUS
    at = np.arange(int(inner.sum())) + np.repeat(np.arange(sizes.size) * 2 * RADIUS + RADIUS, inner)
    weight = np.repeat(times, inner)
    sums = {k: np.zeros_like(v) for k, v in net.w.items()}
    order = positions(at.size, shard, round_no)
    for a in range(0, order.size, BATCH):
        some = order[a : a + BATCH]
        here = at[some]
        net.step(sides_of(line, here), line[here], weight[some], RATE, sums)
    return at.size


def train(dealt: DataFrame, model: Network, round_no: int) -> Network:
    """The average of the copies that the shards train from ``model``, by their positions; itself if there is nothing to train on."""
    start = dealt.sparkSession.sparkContext.broadcast(model.flat())
    cuts = np.linspace(0, model.flat().size, PARTS + 1).astype(int)
    names = ["part", "shard", "n", "weights"]
    schema = "part int, shard bigint, n bigint, weights binary"

    def copy(shard: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows)
        net = Network.from_flat(start.value)
        n = trained(net, whole.column("line").to_pylist(), whole.column("times").to_numpy(), shard, round_no)
        values = net.flat()
        parts = [values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([shard] * PARTS, pa.int64()), pa.array([n] * PARTS, pa.int64()), pa.array(parts, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            shard = batch.column(2).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), shard.size]
            for a, b in zip(cut, cut[1:]):
                if held and shard[a] != now:
                    yield copy(now, held)
                    held = []
                if b > a:
                    now = int(shard[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield copy(now, held)

    def average(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard")
        ns = rows.column("n").to_numpy()
        whole = sum(np.frombuffer(w.as_py(), np.float32).astype(np.float64) * (n / ns.sum()) for w, n in zip(rows.column("weights"), ns))
        part, salt = (k.as_py() for k in key)
        return pa.table([pa.array([part], pa.int32()), pa.array([salt], pa.int64()), pa.array([int(ns.sum())], pa.int64()), pa.array([whole.astype(np.float32).tobytes()], pa.binary())], names=names)

    copies = checkpointed(dealt.select("line", "times", "shard").mapInArrow(run, schema))
    while (n := copies.count() // PARTS) > 1:
        salt = F.pmod(F.col("shard"), F.lit(-(-n // FAN_IN)))
        last, copies = copies, checkpointed(copies.groupBy("part", salt.alias("salt")).applyInArrow(average, schema))
        forget(last)
    parts = {r["part"]: np.frombuffer(bytes(r["weights"]), np.float32) for r in copies.collect()}
    return Network.from_flat(np.concatenate([parts[k] for k in range(PARTS)])) if parts else model


def fit_encoded(seen: DataFrame, names: dict[str, str], ns: list[int], whole: int, rounds: int = ROUNDS) -> Network:
    """The network trained on encoded documents; ns and whole as of vocabulary()."""
    model = Network.new(prior_of(ns, whole))
    if rounds:
        # Lines and copies are read here only; the weights are on the driver when their files go.
        with scratch():
            dealt = shards(seen, names, whole)
            for k in range(rounds):
                with scratch():
                    model = train(dealt, model, k)
    return model


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, counted: DataFrame | None = None) -> tuple[Network, list[str]]:
    """(network, its words) of a corpus. counted: counts() of it."""
    words, ns, whole = vocabulary(checkpointed(counts(docs, text)) if counted is None else counted)
    docs = docs.select(docs[text])
    return fit_encoded(*encoded(docs, words, text, keep_text=False), ns, whole, rounds), words


def own_shares(tokens: DataFrame, counted: DataFrame, words: list[str]) -> DataFrame:
    """tokens (row, h) of words outside ``words`` -> row, own: the log-shares of the words in their ids, summed."""
    bucket = F.shiftrightunsigned(F.col("h"), 64 - BUCKET_BITS)
    known = counted.sparkSession.createDataFrame([(w,) for w in words], "word string")
    beyond = counted.join(F.broadcast(known), "word", "left_anti").select(F.xxhash64("word").alias("h"), "n")
    totals = beyond.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("whole"))  # a row an id
    share = F.coalesce("n", F.lit(1)) / (F.coalesce("whole", F.lit(0)) + 1)
    rows = tokens.join(beyond, "h", "left").withColumn("bucket", bucket).join(F.broadcast(totals), "bucket", "left")
    return rows.select("row", F.round(F.log(share) * MICRO).cast("bigint").alias("x")).groupBy("row").agg((F.sum("x") / MICRO).alias("own"))


def score_encoded(seen: DataFrame, names: dict[str, str], model: Network, words: list[str], counted: DataFrame) -> DataFrame:
    """Encoded documents with n_tokens, log_prob and mean_log_prob in place of their tokens."""
    row = names["row"]
    kept = [c for c in seen.columns if c not in ("n_tokens", *names.values())]
    types = {f.name: f.dataType.simpleString() for f in seen.schema.fields}
    shared = seen.sparkSession.sparkContext.broadcast(model.flat())
    carried = [*kept, row, "n_tokens"]
    total, own, other = fresh(seen, "_sum", "_own", "_own_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.from_flat(shared.value)
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                lengths = batch.column(len(carried) - 1).to_numpy()
                line = np.frombuffer(b"".join(batch.column(len(carried)).to_pylist()), np.int16)
                owner = np.repeat(np.arange(lengths.size), lengths)
                at = np.arange(owner.size) + (owner * 2 + 1) * RADIUS
                sums = np.zeros(lengths.size)
                for b in range(0, at.size, BATCH):
                    piece = at[b : b + BATCH]
                    sums += np.bincount(owner[b : b + BATCH], net.log_prob(sides_of(line, piece), line[piece]), lengths.size)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(carried)], pa.array(sums)], names=[*carried, total])

    schema = ", ".join([f"`{c}` {types[c]}" for c in carried] + [f"`{total}` double"])
    sums = seen.select(*carried, names["ids"]).mapInArrow(run, schema)
    tokens = seen.select(F.col(row).alias("row"), F.explode(names["rare"]).alias("h"))
    shares = own_shares(tokens, counted, words).select(F.col("row").alias(other), F.col("own").alias(own))
    value = F.round(F.col(total) + F.coalesce(own, F.lit(0.0)), 3)
    joined = sums.join(shares, F.col(row) == F.col(other), "left")
    return joined.select(*kept, "n_tokens", value.alias("log_prob"), F.when(F.col("n_tokens") > 0, value / F.col("n_tokens")).alias("mean_log_prob"))


@any_names
def score(docs: DataFrame, model: Network, words: list[str], text: str = "text", keep_text: bool = True, counted: DataFrame | None = None) -> DataFrame:
    """docs with n_tokens, log_prob (summed over the tokens) and mean_log_prob. counted: counts() of the corpus, by default of docs."""
    counted = checkpointed(counts(docs, text)) if counted is None else counted
    return score_encoded(*encoded(docs, words, text, keep_text), model, words, counted)


@any_names
def fit_and_score(docs: DataFrame, text: str = "text", keep_text: bool = True, rounds: int = ROUNDS) -> DataFrame:
    """docs scored by the network of their own corpus; every text is read twice, for counts and for ids."""
    with tidy(docs.sparkSession):
        counted = checkpointed(counts(docs, text))
        words, ns, whole = vocabulary(counted)
        seen, names = encoded(docs, words, text, keep_text)
        model = fit_encoded(seen, names, ns, whole, rounds)
    return score_encoded(seen, names, model, words, counted)
