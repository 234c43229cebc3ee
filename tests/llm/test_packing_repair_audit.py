"""Packing, conversation repair and the filter audit against brute force, with nulls, ties, repeats and odd names."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import groupby, permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from meterlake.llm import conversation_repair as cr
from meterlake.llm import filter_audit, packing, queries

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["a.b", "back`tick", "sequence_id", "Digest", "part", "times", "mask", "length", "same"]


def with_odd_columns(df):
    return df.select("*", *[F.lit("mine").alias(c) for c in ODD if c not in df.columns])


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.packing_tokenizer_path())


# Packing

TEXTS = [None, "", "one", "one two three " * 900, "x" * 3_000, "a <|endoftext|> b<|endoftext|>", "naïve 中文 😀 \x85 it's  \n\n end  ", " " * 12_000 + "end", "\n \t" * 5_000, "word " * 20_000]


def pieces_of(ids, longest=1024):
    at, size = 0, longest
    while at < len(ids):
        while size > len(ids) - at:
            size //= 2
        yield at, ids[at : at + size]
        at += size


def test_packing_equals_brute_force(spark):
    rows = [(k if k else None, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    df = with_odd_columns(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    tok = library()
    want = Counter()
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for at, piece in pieces_of(ids):
            want[(i, at, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)), len(ids), tuple(piece))] += 1
    out = packing.pack(df, queries.packing_tokenizer_path()).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["ids"])) for r in out) == want
    assert len({r["sequence_id"] for r in out}) == len(out) and all(r["offset"] == 0 and 1 << r["bucket"] == r["length"] for r in out)
    assert packing.pack(df.limit(0), queries.packing_tokenizer_path()).count() == 0


def test_packing_of_given_documents(spark):
    tok = library()
    total = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    by = defaultdict(list)
    for r in queries.op11_packing(spark, DATA).collect():
        by[r["doc_id"]].append(r)
    assert by.keys() == total.keys()
    for i, ids in total.items():
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in sorted(by[i], key=lambda r: r["start"])] == [(at, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p))) for at, p in pieces_of(ids)]


def test_packing_takes_other_lengths_and_end_ids_and_writes_buckets(spark, tmp_path):
    df = spark.createDataFrame([("a", "one two three four five six seven"), ("b", "one")], "id string, body string")
    out = packing.pack(df, queries.packing_tokenizer_path(), "id", "body", 4, 50256)
    assert sorted((r["doc_id"], r["start"], r["length"]) for r in out.collect()) == [("a", 0, 4), ("a", 4, 4), ("b", 0, 2)]
    assert {r["ids"][-1] for r in out.where("start + length = doc_tokens").collect()} == {50256}
    packing.write_buckets(out, str(tmp_path / "buckets"))
    read = spark.read.parquet(str(tmp_path / "buckets"))
    assert read.where("bucket = 2").select(F.size("ids")).distinct().collect()[0][0] == 4 and read.count() == 3
    with pytest.raises(ValueError):
        packing.pack(df, queries.packing_tokenizer_path(), "id", "body", 1000)


def test_both_encoders_give_the_same_ids():
    with open(queries.packing_tokenizer_path(), encoding="utf-8") as f:
        quick = packing.encoder(f.read())
    tok, rng = library(), random.Random(3)
    ranges = [(1, 0x250), (0x300, 0x700), (0x900, 0xE00), (0x1680, 0x1681), (0x2000, 0x2100), (0x3000, 0x3100), (0x4E00, 0x4F00), (0xFF00, 0x10000), (0x1F600, 0x1F680), (0x10FF00, 0x10FFFF)]
    for _ in range(600):
        text = "".join(rng.choice([" ", "\n", "'s", "a", "7", chr(rng.randrange(*rng.choice(ranges)))]) for _ in range(60))
        assert quick(text).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_other_tokenizer_files_go_through_the_library(tmp_path):
    from tokenizers import Tokenizer

    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        content = f.read()
    assert packing.ranks_of(content) is None
    assert packing.encoder(content)("It's 12 words").tolist() == Tokenizer.from_str(content).encode("It's 12 words", add_special_tokens=False).ids


# Conversations


def brute_edits(rows):
    """Uniform-cost search over (cost, edits): rows of (initial, fault)."""
    n, queue, seen = len(rows), [(0, "", 0, 0)], set()
    while True:
        cost, edits, i, q = heapq.heappop(queue)
        if i == n and q in (0, 3):
            return cost, edits
        if (i, q) in seen:
            continue
        seen.add((i, q))
        user = q != 2
        heapq.heappush(queue, (cost + 3, edits + "I", i, 2 if user else 3))
        if i == n:
            continue
        initial, fault = rows[i]
        heapq.heappush(queue, (cost + 4, edits + "D", i + 1, q))
        if fault in ("blank", "duplicate"):
            continue
        more = 3 if fault == "truncated" else 0
        heapq.heappush(queue, (cost + 3 + more, edits + "R", i + 1, 2 if user else 3))
        to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, initial))
        if to:
            heapq.heappush(queue, (cost + more, edits + "K", i + 1, to))


def brute_damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield conv, turn, role, text, 0 if kind == 0 else 2 if kind == 3 else 1


def brute_repair(rows):
    """rows: (conv, turn, role, text, times) -> conv: the contract's columns."""
    out = {}
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())
    for conv, of in groupby(sorted(rows, key=order), key=lambda r: r[0]):
        of = [r for r in of for _ in range(r[4])]
        seen, faults, count = set(), [], Counter()
        for _, _, role, text, _ in of:
            words = WORD.findall(text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1][-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            count[fault] += 1
        turns = [r[1] for r in of if r[1] is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(of, of[1:]))
        cost, edits = brute_edits([(r[2][:1], f) for r, f in zip(of, faults)])
        lines, q, at = [], 0, 0
        for e in edits:
            row = None
            if e != "I":
                row, at = of[at], at + 1
            if e == "D":
                continue
            role = row[2] if e == "K" else "assistant" if q == 2 else "user"
            q = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{row[3] if row else ''}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def random_conversations(rng, n, longest):
    texts = ["Yes.", "No!", "cut off", "", "  \t", None, "Why?", "also cut", "fine. ", "ends ", "tab.\t\n"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "Tool", None, ""]) if rng.random() < 0.5 else ("user", "assistant")[turn % 2]
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, turn + 1, None]), role, rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}" + rng.choice(["", ".", "."])))
    return rows


def test_repair_of_damaged_conversations_equals_brute_force(spark):
    rows = random_conversations(random.Random(1), 150, 9) + [(77, 2, "user", "again."), (77, 2, "user", "again.")]
    df = with_odd_columns(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = brute_repair(list(brute_damage(rows)))
    assert found(cr.repair(cr.damaged(df), "times")) == want
    turns = cr.repaired(cr.damaged(df), "times").collect()
    for conv, of in groupby(sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r["turn"])), key=lambda r: r[0]):
        of = list(of)
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in of).encode()).hexdigest() == want[conv][-1]
        assert re.fullmatch("s?(ua)+", "".join(r["role"][0] for r in of)) and [r["edit"] for r in of] == [e for e in want[conv][-2] if e != "D"]
    assert cr.repair(df.limit(0)).count() == 0 and cr.repaired(df.limit(0)).count() == 0


def test_repair_of_given_conversations_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_repair(spark, DATA)) == brute_repair(list(brute_damage(rows)))


@pytest.mark.parametrize("block", [1, 3, 64])
def test_long_conversations_are_cut_anywhere_with_the_same_result(spark, monkeypatch, block):
    """A few conversations that span tasks and blocks, one with a text that repeats very often."""
    monkeypatch.setattr(cr, "BLOCK", block)
    rows = random_conversations(random.Random(block), 4, 160)
    rows += [(9, t, "user", "the same.") for t in range(300)] + [(9, 7, "user", "the same.")] * 50
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(cr.repair(df))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = brute_repair([(c, t, " " if r is None else r, " " if x is None else x, 1) for c, t, r, x in rows])
    assert got == want


def test_search_equals_uniform_cost_search_on_every_short_conversation():
    kinds = [("s", ""), ("u", ""), ("a", ""), ("u", "truncated"), ("a", "truncated"), ("x", ""), ("u", "blank")]

    def coded(of):
        return [("", 1) if f == "blank" else (i, 3 if f else 0) for i, f in of]

    def check(of):
        edge = cr.search(coded(of), (0,), True)
        assert [(c, e) for _, _, c, e in edge] == [brute_edits(of)]
        parts = [{"edges": cr.search(coded([r]), (0, 1, 2, 3), False)} for r in of]
        assert cr.join(parts) == brute_edits(of)

    for a in kinds:
        check([a])
        for b in kinds:
            for c in kinds:
                check([a, b, c])
    rng = random.Random(4)
    for _ in range(300):
        check([rng.choice(kinds) for _ in range(rng.randrange(1, 14))])


def test_failed_states_are_entered_again_only_with_more_to_spend():
    entered = Counter()

    def moves(state):
        i, q = state
        entered[state] += 1
        for step in (1, 2):
            if i < 30:
                yield "ab"[step - 1], (i + 1, (q + step) % 7), step

    cost, letters = cr.cheapest((0, 0), moves, lambda s: s == (30, 5), lambda s: 30 - s[0], 100)
    assert (cost, letters) == (33, "a" * 27 + "bbb") and max(entered.values()) <= cost - 30 + 1


# Filter audit


def brute_audit(docs, labels):
    by_id = defaultdict(list)
    for i, q, t in labels:
        by_id[i].append((q, t))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and first[text] < i}
        marks = by_id[i] if i is not None else []
        rows.append((lang or "", fails, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out = {}
    for part in {r[0] for r in rows}:
        of = [r for r in rows if r[0] == part]
        shares = Counter()
        for order in map("".join, permutations("ABCDE")):
            for s, f in enumerate(order):
                late = [any(x[1][g] for g in order[:s]) for x in of]
                here = [x for x, l in zip(of, late) if x[1][f] and not l]
                shares[f] += len(here)
                out[part, order, s + 1] = [len(of) - sum(late) - len(here), len(here), sum(x[1][f] and l for x, l in zip(of, late)), sum(x[1][f] and sum(x[1].values()) == 1 for x in of), sum(x[2] for x in here), sum(x[3] for x in here)]
        for (p, order, s), row in out.items():
            if p == part:
                row.append(shares[order[s - 1]])
    return out


def test_filter_audit_equals_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    text = lambda: " ".join(rng.sample(words, rng.choice([3, 210, 260])) * rng.choice([1, 1, 3])) + rng.choice(["", " #", " ABC" * 40, " ", "\t\n"])
    some = [None, "", " \n", "A", "%"] + [text() for _ in range(14)]
    docs = [(rng.choice([None, *range(60)]), rng.choice(some), rng.choice(["en", "de", "", None])) for _ in range(150)]
    docs += docs[:8] + [(500 + k, some[6], "en") for k in range(40)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(50)]
    labels = labels + labels[:5]
    df = with_odd_columns(spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(3))
    marks = with_odd_columns(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {(r["part"], r["filter_order"], r["step"]): [r[m] for m in filter_audit.MEASURES] for r in filter_audit.audit(df, marks).collect()}
    assert got == brute_audit(docs, labels)
    assert filter_audit.audit(df.limit(0), marks).count() == 0
    assert filter_audit.audit(df, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_wide_counters_do_not_overflow():
    orders, table = filter_audit.packed("ABCDE")
    n = (1 << 62) // len(table)
    rows = filter_audit.report("p", [(m, True, False, n) for m in range(32)], "ABCDE", orders, table)
    assert len(orders) == 120 and (rows["kept"].iloc[4], rows["removed"].iloc[0], rows["redundant"].iloc[4]) == (n, 16 * n, 15 * n)
    # In one order a document is removed once at most, so a filter's shapley share is spread over the steps.
    assert set(rows["shapley"]) == {int(rows.loc[rows["filter_order"].str[0] == "A", "shapley"].iloc[0])}


def test_filter_audit_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    df = queries.op13_filter_audit(spark, DATA)
    want = con.execute(queries.ORACLES["op13_filter_audit"])
    assert [d[0] for d in want.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())
