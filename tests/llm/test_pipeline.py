"""The pipeline on the smallest tables against its stages by brute force."""

from __future__ import annotations

import hashlib
import math

import pytest

from test_text_operators import brute_similar, brute_spans, brute_statistics

import corpus_pipeline
from meterlake.llm.queries import tokenizer_path

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_their_decisions_hold(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, DATA).cache()
        rows[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    kept = rows["quality rules"]
    assert all(n >= 10 and 100 * r <= 20 * n for n, *_, r in (brute_statistics(x["text"]) for x in kept))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = {d for d, q in labels.items() if q == 1}
    passed = {r["doc_id"] for r in kept}
    base = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if (s := brute_statistics(r["text"]))[0] >= 10 and 100 * s[4] <= 20 * s[0]}
    assert len(good & base - passed) <= 0.02 * len(good)
    single = rows["near-duplicates"]
    assert sorted(r["doc_id"] for r in single) == sorted(set(brute_similar([(r["doc_id"], r["text"]) for r in kept]).values()))
    text = {r["doc_id"]: r["text"] for r in single}
    clean = rows["personal data"]
    assert len(clean) == len(single) and all(not brute_spans(r["text"]) for r in clean)
    assert all(r["text"] == text[r["doc_id"]] for r in clean if not brute_spans(text[r["doc_id"]]) and "[ID]" not in r["text"])
    sizes = {}
    for r in clean:
        sizes[r["source"]] = sizes.get(r["source"], 0) + 1
    total = sum(n**0.5 for n in sizes.values())
    want = []
    for r in clean:
        rate = sizes[r["source"]] ** 0.5 / total * len(clean) / sizes[r["source"]]
        u = int(hashlib.md5(f"42:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        k, p, cdf = 0, math.exp(-rate), math.exp(-rate)
        while cdf <= u:
            k += 1
            p *= rate / k
            cdf += p
        want += [r["doc_id"]] * k
    assert sorted(r["doc_id"] for r in rows["mixing"]) == sorted(want)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    source = {r["doc_id"]: r["text"] for r in clean}
    for r in rows["byte-pair encoding"]:
        assert r["token_ids"] == library.encode(source[r["doc_id"]], add_special_tokens=False).ids
    assert corpus_pipeline.run(spark, DATA).count() == len(rows["byte-pair encoding"])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_nulls_repeats_extra_columns_and_nothing(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    clashes = ["n_words", "kept", "copy", "_times", "_key", "found_spans", "_row_id", "row", "_words", "a.b", "back`tick"]
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(k, t, "en", s, 1, *[f"{c} {k}" for c in clashes]) for k, (t, s) in enumerate([(None, "a"), ("", None), (words, "b"), (words + " nu", "a"), ("mail a@b.org " + words, None), (words * 3_000, "b")], 1_000_000)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in clashes)
    df = spark.createDataFrame(rows + rows[2:3], schema)
    out = stage(spark, df, DATA)
    assert out.columns[: len(df.columns)] == df.columns
    for r in out.collect():
        assert all(r[c] == f"{c} {r['doc_id']}" for c in clashes)
    assert stage(spark, df.limit(0), DATA).count() == 0
