"""Exact substring deduplication with suffix arrays built by two-stage sorting.

A byte goes if a SPAN-byte string that covers it also starts in a document with a smaller id. The work:

1. Texts are packed by a hash of their bytes into groups of a few MB (equal texts meet, one copy stays, under their
   smallest id). Every SPAN-byte string is named by the smallest hash of its K-grams, so equal strings have equal names
   wherever they are. Names that occur in one text only need no further look.
2. Runs of neighbouring strings with one shared name become fragments, at most 2 * SPAN bytes, once a group. All
   fragments of a name go to one block. A name in very many texts (the border of a common passage may have a different
   fragment in each) is sent string by string instead, to the block of the string's hash; equal strings still meet.
3. A block's suffix array is built in two stages: suffixes that are smaller than their successors are sorted directly, the
   others are induced by scanning the buckets in order. Adjacent common prefixes of SPAN bytes or more tie equal
   strings, and each takes the smallest id of its tie.
4. Those fragments go back to the groups in which some text loses a string; the groups cut the bytes out.

Groups and blocks grow in number with the input, never in size, and a passage or text that a third of all documents
share moves once a task, not once a document.

Defined cases: null text is empty. Texts under SPAN bytes lose nothing. Rows with a null id count as after all others
and do not remove from each other. Rows with equal ids do not remove from each other unless their texts differ and a
smaller id has the string too; repeated rows get equal results. Matches never cross documents. An empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
import marshal
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: K-grams short enough to recur by chance make names shared that no string shares, the more the larger the corpus.
SPAN, K = 50, 32
WINDOW = SPAN - K + 1
#: Bytes of text in a group; strings in a fragment. Fragments repeat a text's bytes 3.5 times at most, so as many blocks
#: a group keep blocks as small as groups.
GROUP_BYTES, RUN, BLOCKS_A_GROUP = 4 << 20, WINDOW, 3
#: Names in more texts are sent to blocks string by string.
MANY = 512
NO_ID = (1 << 63) - 1
U = np.uint64


# Names of strings


def names(text: bytes) -> np.ndarray:
    """For each SPAN-byte string of the text, a number made of the smallest hash of its K-grams."""
    x = np.frombuffer(text, np.uint8).astype(U)
    x += U(1)
    power = 0x9E3779B97F4A7C15
    width = 1
    while width < K:
        x = x[:-width] * U(power) + x[width:]
        power = power * power % (1 << 64)
        width *= 2
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(32)
    n, width = x.size - WINDOW + 1, 1
    while width * 2 <= WINDOW:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    # Smallest hashes crowd at the low end; a bijection spreads them evenly.
    return np.minimum(x[:n], x[WINDOW - width : WINDOW - width + n]) * U(0x94D049BB133111EB)


def runs(named: np.ndarray, shared: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, end, name) of runs of neighbouring strings with one name, of the sorted shared names only."""
    starts = np.flatnonzero(np.r_[True, named[1:] != named[:-1]])
    ends = np.r_[starts[1:], named.size]
    own = named[starts]
    at = np.minimum(np.searchsorted(shared, own), shared.size - 1)
    hit = shared[at] == own
    out = []
    for a, b, h in zip(starts[hit].tolist(), ends[hit].tolist(), own[hit].tolist()):
        out += [(s, min(s + RUN, b), h) for s in range(a, b, RUN)]
    return out


# Packing


def pack(ids: list[int], texts: list[bytes]) -> bytes:
    head = struct.pack("<q", len(ids)) + np.array(ids, np.int64).tobytes() + np.array(list(map(len, texts)), np.int64).tobytes()
    return zstandard.compress(head + b"".join(texts), 3)


def unpack(blobs: Iterator[bytes]) -> dict[bytes, int]:
    """Text to smallest id over all blobs."""
    out: dict[bytes, int] = {}
    for blob in blobs:
        data = zstandard.decompress(blob)
        n = struct.unpack_from("<q", data)[0]
        ids, lengths = np.frombuffer(data, np.int64, n, 8).tolist(), np.frombuffer(data, np.int64, n, 8 + 8 * n).tolist()
        at = 8 + 16 * n
        for i, size in zip(ids, lengths):
            text = data[at : at + size]
            at += size
            out[text] = min(i, out.get(text, i))
    return out


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte of the same weight, compressed."""
    if not values.size:
        return b""
    steps = np.diff(values, prepend=U(0))
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, U)
    steps = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1).T.copy().view(U).reshape(-1)
    return np.cumsum(steps, dtype=U)


def packed(docs: DataFrame, groups: int) -> DataFrame:
    """(grp, blob): the distinct texts of SPAN bytes or more, by group, each batch's copies reduced to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[bytes, int] = {}
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                text = t.as_py()
                if len(text) >= SPAN:
                    own[text] = min(i, own.get(text, i))
            by: dict[int, tuple[list[int], list[bytes]]] = {}
            for text, i in own.items():
                ids, texts = by.setdefault(xxhash.xxh64_intdigest(text) % groups, ([], []))
                ids.append(i)
                texts.append(text)
            if by:
                yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.int32()), pa.array([pack(*x) for x in by.values()], pa.binary())], names=["grp", "blob"])

    return docs.select("_id", "_text").mapInArrow(run, "grp int, blob binary")


# The suffix array


def types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last counts as such."""
    step = np.sign(np.diff(t.astype(np.int16)))
    decided = np.where(step != 0, np.arange(step.size), step.size)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return np.r_[np.r_[step, 1][following] > 0, True]


def words(t: np.ndarray) -> np.ndarray:
    """Seven characters from each place on as one number of 9 bits each, zeros after the end."""
    wide = np.r_[t.astype(U), np.zeros(64, U)]
    out = np.zeros(t.size + 57, U)
    for k in range(7):
        out |= wide[k : k + out.size] << U(9 * (6 - k))
    return out


def directly_sorted(w: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places by their first 56 characters: by the first word, then ties only by the next ones."""
    order = places[np.argsort(w[places], kind="stable")]
    value = w[order]
    rank = np.cumsum(np.r_[True, value[1:] != value[:-1]]) if order.size else np.empty(0, np.int64)
    for depth in range(7, 56, 7):
        same = np.r_[False, rank[1:] == rank[:-1]] if order.size else np.empty(0, bool)
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not tied.size:
            break
        sub = order[tied]
        value, group = w[sub + depth], rank[tied]
        by = np.lexsort((value, group))
        order[tied], value, group = sub[by], value[by], group[by]
        fresh = np.zeros(order.size, np.int64)
        fresh[tied[1:]] = (group[1:] == group[:-1]) & (value[1:] != value[:-1])
        rank = rank + np.cumsum(fresh)
    return order


def suffix_array(t: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Needed places in suffix order. t: characters, 0 between fragments and at the end; needed is closed: with a
    suffix that is not smaller than its successor, the successor is needed too."""
    smaller = types(t)
    induce = needed & ~smaller
    direct = directly_sorted(words(t), np.flatnonzero(needed & smaller))
    first = t[direct]
    bounds = np.searchsorted(first, np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in np.flatnonzero(np.bincount(t[needed], minlength=257)).tolist():
        front = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        parts = [front]
        while front.size:  # runs of one character, one step longer each time
            front = front[front > 0] - 1
            front = front[induce[front] & (t[front] == c)]
            parts.append(front)
        bucket = np.concatenate([*parts, direct[bounds[c] : bounds[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induce[before]]
        chars = t[before]
        before, chars = before[chars > c], chars[chars > c]
        by = np.argsort(chars, kind="stable")
        before, chars = before[by], chars[by]
        cut = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]]) if chars.size else np.empty(0, np.int64)
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), chars.size]):
            waiting[int(chars[a])].append(before[a:b])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(w: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Common prefix of each place with the one before it, up to 56 characters; 0 for the first."""
    length, open_ = np.zeros(places.size, np.int64), np.ones(places.size, bool)
    open_[:1] = False
    for depth in range(0, 56, 7):
        at = np.flatnonzero(open_)
        if not at.size:
            break
        differ = w[places[at] + depth] ^ w[places[at - 1] + depth]
        same = differ == 0
        part = np.zeros(at.size, np.int64)
        for k in range(1, 7):
            part += differ < (U(1) << U(63 - 9 * k))
        length[at] += np.where(same, 7, part)
        open_[at[~same]] = False
    return length


def smallest_ids(fragments: list[bytes], ids: list[int]) -> list[np.ndarray]:
    """For each SPAN-byte string of each fragment, the smallest id among the fragments that have it."""
    lengths = np.array([len(f) for f in fragments], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    t = np.zeros(int(starts[-1] + lengths[-1] + 1), np.uint16)
    body = np.frombuffer(b"\0".join(fragments) + b"\0", np.uint8).astype(np.uint16) + 1
    body[starts + lengths] = 0
    t[:] = body
    string = np.zeros(t.size, bool)
    counts = lengths - SPAN + 1
    string[np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = True
    smaller = types(t)
    # Up to the first directly sorted place at or after the last string of each fragment.
    at_or_after = np.minimum.accumulate(np.where(smaller, np.arange(t.size), t.size)[::-1])[::-1]
    ends = at_or_after[starts + counts - 1] + 1
    edge = np.zeros(t.size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    needed = np.cumsum(edge[:-1]) > 0
    order = suffix_array(t, needed)
    order = order[string[order]]
    tie = np.cumsum(common_prefixes(words(t), order) < SPAN) - 1
    owner = np.repeat(np.arange(len(fragments)), counts)
    row = np.empty(t.size, np.int64)
    row[string] = np.arange(owner.size)
    doc = np.array(ids, np.int64)[owner[row[order]]]
    best = np.minimum.reduceat(doc, np.flatnonzero(np.r_[True, tie[1:] != tie[:-1]]))
    found = np.empty(owner.size, np.int64)
    found[row[order]] = best[tie]
    return np.split(found, np.cumsum(counts)[:-1])


def to_bytes(found: np.ndarray) -> bytes:
    return found[:1].tobytes() if (found == found[0]).all() else found.tobytes()


# What groups and blocks send each other


def pack_columns(*columns: list | np.ndarray) -> bytes:
    """Numbers (as arrays) and byte strings (as lists) of one length."""
    out = [c.tobytes() if isinstance(c, np.ndarray) else (np.array(list(map(len, c)), np.int32).tobytes(), b"".join(c)) for c in columns]
    return zstandard.compress(marshal.dumps(out), 3)


def unpack_columns(blob: bytes, *kinds: type) -> list[list]:
    """kinds: a numpy type, or bytes, for each column."""
    out = []
    for value, kind in zip(marshal.loads(zstandard.decompress(blob)), kinds):
        if kind is bytes:
            ends = np.cumsum(np.frombuffer(value[0], np.int32), dtype=np.int64).tolist()
            out.append([value[1][a:b] for a, b in zip([0, *ends], ends)])
        else:
            out.append(np.frombuffer(value, kind).tolist())
    return out


# The steps on Spark


def shared_names(packs: DataFrame, buckets: int) -> DataFrame:
    """(grp, names, many): for each group, its names that occur in two texts or more; many: in more than MANY texts."""
    width = min((1 << 64) // buckets + 1, (1 << 64) - 1)

    def gather(table: pa.Table) -> pa.Table:
        own = [np.unique(names(text)) for text in unpack(b.as_py() for b in table.column("blob"))]
        every = np.sort(np.concatenate(own))
        new = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        values, n = every[new], np.diff(np.r_[new, every.size]).astype(np.uint32)
        bucket = (values // U(width)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        parts = [(int(bucket[a]), values[a:b], n[a:b]) for a, b in zip(cut.tolist(), [*cut[1:].tolist(), bucket.size])]
        grp = table.column("grp")[0].as_py()
        blobs = [[pack_sorted(v[m == 1]) for _, v, m in parts], [pack_sorted(v[m > 1]) for _, v, m in parts], [zstandard.compress(m[m > 1].tobytes(), 1) for _, _, m in parts]]
        return pa.table([pa.array([p[0] for p in parts], pa.int64()), pa.array([grp] * len(parts), pa.int32()), *[pa.array(b, pa.binary()) for b in blobs]], names=["bucket", "grp", "one", "more", "texts"])

    def answer(table: pa.Table) -> pa.Table:
        grps = table.column("grp").to_pylist()
        ones = [unpack_sorted(b.as_py()) for b in table.column("one")]
        mores = [unpack_sorted(b.as_py()) for b in table.column("more")]
        texts = [np.frombuffer(zstandard.decompress(b.as_py()), np.uint32) for b in table.column("texts")]
        every = np.concatenate([*ones, *mores])
        weight = np.concatenate([np.ones(sum(x.size for x in ones), np.int64), *[x.astype(np.int64) for x in texts]])
        order = np.argsort(every, kind="stable")
        every, weight = every[order], weight[order]
        start = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        values, n = every[start], np.add.reduceat(weight, start)
        some, many = values[n > 1], values[n > MANY]
        has = lambda x, of: x[of[np.minimum(np.searchsorted(of, x), of.size - 1)] == x] if of.size else x[:0]
        own = [np.sort(np.concatenate(x)) for x in zip(ones, mores)]
        replies = [has(x, some) for x in own]
        kept = [k for k, r in enumerate(replies) if r.size]
        return pa.table([pa.array([grps[k] for k in kept], pa.int32()), pa.array([pack_sorted(replies[k]) for k in kept], pa.binary()), pa.array([pack_sorted(has(own[k], many)) for k in kept], pa.binary())], names=["grp", "names", "many"])

    gathered = packs.groupBy("grp").applyInArrow(gather, "bucket bigint, grp int, one binary, more binary, texts binary")
    return gathered.groupBy("bucket").applyInArrow(answer, "grp int, names binary, many binary")


def pieces(text: bytes, shared: np.ndarray, many: set[int]) -> Iterator[tuple[int, int, bytes, int]]:
    """(place, strings, content, name) of the text's fragments; those of a name with many texts string by string."""
    for a, b, h in runs(names(text), shared):
        if h in many:
            for k in range(a, b):
                yield k, 1, text[k : k + SPAN], h
        else:
            yield a, b - a, text[a : b + SPAN - 1], h


def fragments(packs: DataFrame, shared: DataFrame, blocks: int) -> DataFrame:
    """(block, grp, blob): the fragments of shared names, once a group, by the block of their name; those of a name
    with many texts by the block of their content, so that neither holds more than a bounded share."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[bytes, list] = {}
        if right.num_rows and left.num_rows:
            shared = np.sort(np.concatenate([unpack_sorted(b.as_py()) for b in right.column("names")]))
            many = {h for b in right.column("many") for h in unpack_sorted(b.as_py()).tolist()}
            for text, i in unpack(b.as_py() for b in left.column("blob")).items():
                for _, _, content, h in pieces(text, shared, many):
                    known = found.get(content)
                    if known is None:
                        found[content] = [i, h, h in many, i, i]
                    else:
                        known[3], known[4] = min(known[3], i), max(known[4], i)
        by: dict[int, list[bytes]] = {}
        for content, x in found.items():
            by.setdefault((xxhash.xxh64_intdigest(content) if x[2] else x[1]) % blocks, []).append(content)
        grp = left.column("grp")[0].as_py() if left.num_rows else 0
        column = lambda part, k, kind: np.array([found[c][k] for c in part], kind)
        blobs = [pack_columns(part, column(part, 1, U), column(part, 2, np.uint8), column(part, 3, np.int64), column(part, 4, np.int64)) for part in by.values()]
        return pa.table([pa.array(list(by), pa.int64()), pa.array([grp] * len(by), pa.int32()), pa.array(blobs, pa.binary())], names=["block", "grp", "blob"])

    return packs.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(cut, "block bigint, grp int, blob binary")


def in_blocks(parts: DataFrame) -> DataFrame:
    """(grp, blob): for each group, the fragments in which some text of it loses a string, with the smallest ids of
    their strings, found by a suffix array over the block's different fragments."""

    def array(table: pa.Table) -> pa.Table:
        smallest: dict[bytes, int] = {}
        wanted = []
        for grp, blob in zip(table.column("grp").to_pylist(), table.column("blob")):
            for content, name, many, low, high in zip(*unpack_columns(blob.as_py(), bytes, U, np.uint8, np.int64, np.int64)):
                smallest[content] = min(low, smallest.get(content, low))
                wanted.append((grp, content, name, many, high))
        found = dict(zip(smallest, smallest_ids(list(smallest), list(smallest.values()))))
        by: dict[int, list] = {}
        for grp, content, name, many, high in wanted:
            ids = found[content]
            if ids.min() < high:
                by.setdefault(grp, []).append((xxhash.xxh3_128_digest(content), name, many, to_bytes(ids)))
        blobs = [pack_columns([x[0] for x in rows], np.array([x[1] for x in rows], U), np.array([x[2] for x in rows], np.uint8), [x[3] for x in rows]) for rows in by.values()]
        return pa.table([pa.array(list(by), pa.int32()), pa.array(blobs, pa.binary())], names=["grp", "answer"])

    return parts.groupBy("block").applyInArrow(array, "grp int, answer binary")


def results(packs: DataFrame, answers: DataFrame) -> DataFrame:
    """(text_key, first, n_removed, n_spans, kept_sha256) of every packed text."""

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            known, shared, many = {}, set(), set()
            for blob in right.column("answer") if right.num_rows else ():
                for key, name, is_many, ids in zip(*unpack_columns(blob.as_py(), bytes, U, np.uint8, bytes)):
                    known[key] = ids
                    shared.add(name)
                    if is_many:
                        many.add(name)
            sorted_names = np.sort(np.array(list(shared), U))
            for text, i in unpack(b.as_py() for b in left.column("blob")).items():
                spans = removed(text, i, sorted_names, many, known) if shared else []
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                rows.append((xxhash.xxh3_128_digest(text), i, sum(b - a for a, b in spans), len(spans), hashlib.sha256(b"".join(kept)).hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["text_key", "first", "n_removed", "n_spans", "kept_sha256"])

    return packs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(apply, "text_key binary, first bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def removed(text: bytes, own: int, shared: np.ndarray, many: set[int], known: dict[bytes, bytes]) -> list[tuple[int, int]]:
    """The text's removed byte ranges, maximal and in order."""
    out: list[list[int]] = []

    def add(a: int, b: int) -> None:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])

    for a, n, content, _ in pieces(text, shared, many):
        ids = known.get(xxhash.xxh3_128_digest(content))
        if ids is None:
            continue
        if len(ids) == 8:
            if int.from_bytes(ids, "little", signed=True) < own:
                add(a, a + n + SPAN - 1)
            continue
        for k in np.flatnonzero(np.frombuffer(ids, np.int64) < own).tolist():
            add(a + k, a + k + SPAN)
    return [(a, b) for a, b in out]


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of docs: its id, n_bytes, n_removed, n_spans and kept_sha256."""
    rows = docs.select(docs[doc_id].cast("bigint").alias("_doc"), F.coalesce(docs[doc_id].cast("bigint"), F.lit(NO_ID)).alias("_id"), text_of(docs, text).cast("string").alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    groups = max(1, math.ceil(size / GROUP_BYTES))
    packs = packed(rows, groups)
    parts = fragments(packs, shared_names(packs, groups), BLOCKS_A_GROUP * groups)
    done = results(packs, in_blocks(parts))
    return labelled(rows).join(done, "text_key", "left").select(
        F.col("_doc").alias(doc_id),
        "n_bytes",
        F.when(F.col("first").isNull(), 0).when(F.col("first") == F.col("_id"), F.col("n_removed")).otherwise(F.col("n_bytes")).cast("bigint").alias("n_removed"),
        F.when(F.col("first").isNull(), 0).when(F.col("first") == F.col("_id"), F.col("n_spans")).otherwise(1).cast("bigint").alias("n_spans"),
        F.when(F.col("first").isNull(), F.col("own_sha256")).when(F.col("first") == F.col("_id"), F.col("kept_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("kept_sha256"),
    )


def labelled(rows: DataFrame) -> DataFrame:
    """_doc, _id, text_key, n_bytes, and own_sha256 for texts too short to lose anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(2).cast(pa.binary())]
            short = [hashlib.sha256(t).hexdigest() if len(t) < SPAN else None for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()), pa.array(list(map(len, texts)), pa.int64()), pa.array(short, pa.string())], names=["_doc", "_id", "text_key", "n_bytes", "own_sha256"])

    return rows.mapInArrow(run, "_doc bigint, _id bigint, text_key binary, n_bytes bigint, own_sha256 string")
