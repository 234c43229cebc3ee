"""Byte-pair encoding and decoding with a public tokenizer file.

A word's symbols form a doubly linked list; a priority queue holds the possible merges by rank, then place. The best is
taken, entries whose symbols have changed since are skipped, and the two new neighbours are queued: n log n for a word
of n symbols, however long. Decoding concatenates vocabulary strings, one space between tokens where the file names no
decoder.

The file's text rules are: special tokens are cut out of the raw text first; the rest is brought to NFC and lower case,
split into contractions, letter runs, single digits and runs of other marks, white space dropped; bytes are written as
visible characters. None of the rules looks across white space, so results are kept by white-space-delimited chunk.

Defined cases: null text is empty and has no tokens. Equal texts have equal tokens. Nothing is cut, whatever the length.
Extra columns stay; result columns of the same names are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import any_names, fresh

#: Results kept by each Python worker: chunks up to this length, so many of them; the half that was not asked for of late goes.
CHUNK_CHARS, CHUNKS_KEPT = 48, 500_000
#: Rows of an Arrow batch worked on, and sent on, at once.
ROWS = 256
#: Separators of str.split() that Unicode does not count as white space.
NOT_WHITE = regex.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The visible character for each byte: itself where it prints in Latin-1, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder for a tokenizers JSON file of the byte-level kind with word ends."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = model["vocab"] | self.special
        self.strings = {i: t for t, i in self.ids.items()}
        self.strings_of_ids = [str(i) for i in range(max(self.strings) + 1)]
        visible = byte_characters()
        self.first, self.last = [self.ids[c] for c in visible], [self.ids[c + self.suffix] for c in visible]
        #: By rank: the pair of ids as one number, and the id that it becomes. rank: the pair's rank.
        self.pairs = [self.ids[a] << 20 | self.ids[b] for a, b in model["merges"]]
        self.becomes = [self.ids[a + b] for a, b in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(self.pairs)}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.white = regex.compile(r"\p{White_Space}+")
        self.chunks: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def merged(self, word: str) -> list[int]:
        """The final ids of one piece."""
        data = word.encode()
        symbols = [self.first[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        n, rank, pairs, becomes = len(symbols), self.rank.get, self.pairs, self.becomes
        # A queued merge is one number: its rank, then the place of its left symbol.
        queue = [r * n + i for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank(pair[0] << 20 | pair[1])) is not None]
        if not queue:
            return symbols
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        while queue:
            r, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if j < 0 or symbols[i] << 20 | symbols[j] != pairs[r]:
                continue  # one of the two has been merged since
            symbols[i] = made = becomes[r]
            symbols[j] = -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (r := rank(made << 20 | symbols[k])) is not None:
                    heapq.heappush(queue, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] << 20 | made)) is not None:
                heapq.heappush(queue, r * n + h)
        return [s for s in symbols if s >= 0]

    def pieces_of(self, chunk: str) -> list[str]:
        return self.pieces.findall(self.lowered(unicodedata.normalize("NFC", chunk)))

    def piece(self, piece: str) -> tuple[int, str, str]:
        ids, number, string = self.merged(piece), self.strings_of_ids, self.strings
        return len(ids), " ".join([number[i] for i in ids]), " ".join([string[i] for i in ids])

    @staticmethod
    def lowered(text: str) -> str:
        """Lower case character by character: a final sigma is like any other."""
        return text.replace("Σ", "σ").lower()

    def chunk(self, chunk: str) -> tuple[int, str, str]:
        """(tokens, ids joined by a space, strings joined by a space); a lower-case piece is a chunk of its own."""
        if found := self.chunks.get(chunk) or self.older.get(chunk):
            return self.keep(chunk, found)
        pieces = [chunk] if chunk.isascii() and chunk.isalpha() and chunk.islower() else self.pieces_of(chunk)
        if pieces == [chunk]:
            found = self.piece(chunk)
        else:
            parts = [self.chunks.get(p) or self.chunk(p) for p in pieces]
            found = sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])
        return self.keep(chunk, found) if len(chunk) <= CHUNK_CHARS else found

    def keep(self, chunk: str, found: tuple[int, str, str]) -> tuple[int, str, str]:
        if len(self.chunks) >= CHUNKS_KEPT // 2:
            self.chunks, self.older = {}, self.chunks
        self.chunks[chunk] = found
        return found

    def parts(self, text: str) -> Iterator[tuple[int, str, str]]:
        for segment in self.cut.split(text) if self.cut and any(x in text for x in self.special) else (text,):
            if segment in self.special:
                yield 1, str(self.special[segment]), segment
                continue
            chunks = self.white.split(segment) if NOT_WHITE.search(segment) else segment.split()
            get, make = self.chunks.get, self.chunk
            for c in chunks:
                if c:
                    yield get(c) or make(c)

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) if ids for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)

    def summary(self, text: str) -> tuple[int, str, str]:
        """(tokens, SHA-256 of the ids, SHA-256 of the decoded text) without building the list of ids."""
        parts = [p for p in self.parts(text) if p[0]]
        ids, strings = " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])
        return sum([p[0] for p in parts]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(strings.encode()).hexdigest()


_CODECS: dict[str, Codec] = {}


def codec_of(content: str) -> Codec:
    """One codec a worker process and file, so that its kept chunks serve all its tasks."""
    name = hashlib.sha256(content.encode()).hexdigest()
    if name not in _CODECS:
        _CODECS[name] = Codec(content)
    return _CODECS[name]


def _mapped(docs: DataFrame, text: str, path: str, outputs: list[tuple[str, str]], make, keep_text: bool = True) -> DataFrame:
    """docs with the outputs of make(codec, text). The file is read once, on the driver, and broadcast: some 2 MB."""
    with open(path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    docs = docs.drop(*[n for n, _ in outputs if n != text])
    kept = [c for c in docs.columns if c not in {n for n, _ in outputs} and (keep_text or c != text)]
    fields = {f.name: f for f in docs.schema.fields}
    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(content.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                made = [make(codec, t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
                arrays = [pa.array([m[k] for m in made], types[kind]) for k, (_, kind) in enumerate(outputs)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], names=[*kept, *[n for n, _ in outputs]])

    schema = ", ".join([f"`{c}` {fields[c].dataType.simpleString()}" for c in kept] + [f"`{n}` {kind}" for n, kind in outputs])
    return docs.select(*kept, docs[text].cast("string").alias(fresh(docs, "_text_to_encode")[0])).mapInArrow(run, schema)


@any_names
def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with token_ids."""
    return _mapped(docs, text, path, [("token_ids", "array<int>")], lambda codec, t: (codec.encode(t),))


@any_names
def summaries(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs without its text but with n_tokens, ids_sha256 and decoded_sha256 of the encoded and decoded text."""
    return _mapped(docs, text, path, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], lambda codec, t: codec.summary(t), keep_text=False)


@any_names
def tokenised(docs: DataFrame, path: str, text: str = "text", decoded: str = "text") -> DataFrame:
    """docs with token_ids and n_tokens, and with the text that the tokens decode to, what a model sees of it, as ``decoded``."""

    def make(codec: Codec, t: str) -> tuple[str, list[int], int]:
        parts = [p for p in codec.parts(t) if p[0]]
        ids = np.fromstring(" ".join([p[1] for p in parts]), np.int32, sep=" ")
        return " ".join([p[2] for p in parts]), ids, len(ids)

    return _mapped(docs, text, path, [(decoded, "string"), ("token_ids", "array<int>"), ("n_tokens", "long")], make)
