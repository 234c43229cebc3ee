"""Packing by power-of-two decomposition: no padding, and no sequence that crosses documents.

A document's token ids, with the end id after them, are cut into pieces of the longest length and then into the powers of two
that its rest is the sum of, the longest first. Every piece is a sequence of its own, so attention never reaches another
document; sequences of one length form a bucket, and a bucket's rows stack into batches without padding. Work and memory are
a document's own: nothing is sorted or shuffled, one very long or very common document changes nothing for the others.

Ids are those of the ``tokenizers`` library for the file at hand. A plain byte-level file is encoded from its own vocabulary by
``tiktoken``, which gives the same ids in a fifth of the time (tested on every code point); other files, and texts with very
long runs of white space, go through the library itself.

Defined cases: null text is empty, and has the end id only. Texts are read whole. Repeated rows give the same pieces each,
with sequence ids of their own; so do rows of null id. Columns other than id and text are left out, whatever their names. An empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Length of the longest pieces, a power of two.
LONGEST = 1024
#: The id after each document's last one.
END = 0
#: Fixed value: how byte-level files cut text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space from here on are left to the library.
WHITE_RUN = 10_000
#: Token ids in an Arrow batch, about.
BATCH_IDS = 1 << 20


def bytes_of_characters() -> dict[str, int]:
    """The characters that byte-level files write bytes as: printable ones of Latin-1 as they are, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def ranks_of(content: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """(id by token bytes, id by special token) of a file whose ids follow its merges; None for any other file."""
    file = json.loads(content)
    model, before = file["model"], file.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    plain = model["type"] == "BPE" and not file["normalizer"] and before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before["use_regex"]
    if not plain or model.get("dropout") or model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    back = bytes_of_characters()
    return {bytes(map(back.get, t)): i for t, i in model["vocab"].items() if t not in special}, special


def encoder(content: str) -> Callable[[str], np.ndarray]:
    """text -> ids, as the library's encode(text, add_special_tokens=False)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are parallel already
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(content)
    library.no_truncation()
    library.no_padding()
    whole = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)
    known = ranks_of(content)
    if known is None:
        return whole
    import re

    import tiktoken

    quick = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=known[0], special_tokens=known[1])
    allowed, white = set(known[1]), re.compile(r"\s{%d}" % WHITE_RUN)

    def ids(text: str) -> np.ndarray:
        if len(text) >= WHITE_RUN and white.search(text):
            return whole(text)
        return quick.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())

    return ids


_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


def encoder_of(content: str) -> Callable[[str], np.ndarray]:
    """One encoder a worker process and file."""
    name = hashlib.sha256(content.encode()).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = encoder(content)
    return _ENCODERS[name]


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """The longest pieces first, then the powers of two in what is left of n."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST, end: int = END, keep_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start and length in its document, ids (if kept), ids_crc32, doc_tokens, sequence_id, offset and bucket.

    offset is the piece's place in its sequence, bucket the power of two of the sequence's length. The tokenizer's file is read once, on
    the driver, and broadcast: some 2 MB.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    with open(path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder_of(content.value), np.array([end], "<u4")
        for batch in batches:
            rows, start, length, crc, total, kept, held = [], [], [], [], [], [], 0

            def full() -> pa.RecordBatch:
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                if keep_ids:
                    flat = pa.array(np.concatenate(kept) if kept else np.array([], np.uint32)).cast(pa.int32())
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length))), pa.int32()), flat))
                return pa.RecordBatch.from_arrays(arrays, names=names)

            for row, value in enumerate(batch.column(1)):
                ids = np.concatenate((encode(value.as_py() or ""), last)).astype("<u4", copy=False)
                at = 0
                for n in lengths(len(ids), longest):
                    piece = ids[at : at + n]
                    rows.append(row)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids))
                    if keep_ids:
                        kept.append(piece)
                    at, held = at + n, held + n
                    if held >= BATCH_IDS:
                        yield full()
                        rows, start, length, crc, total, kept, held = [], [], [], [], [], [], 0
            yield full()

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if keep_ids else "")
    pieces = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.log2("length").cast("int")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """A folder a length: a reader takes one bucket and stacks its rows into batches of equal sequences."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
