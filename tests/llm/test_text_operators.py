"""Text operators against brute force: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from meterlake.llm import audio, bpe, html_extract, lm_scoring, pii, poisson_mixing, quality_rules, queries, simhash, suffix_dedup, url_filter
from meterlake.llm.queries import RULES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
rng = random.Random(5)
SENTENCE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
LONG = " ".join(rng.choice(SENTENCE.split()) + str(rng.randrange(40)) for _ in range(20_000))
TEXTS = [
    None, "", "   \n\t ", "a", "one two", "one two three", SENTENCE, SENTENCE, SENTENCE.upper(), SENTENCE + " end", LONG, LONG[:60_000], "x" * 5_000, "ab" * 3_000, SENTENCE + "\n" + SENTENCE + "\n\nline\nline",
    "Ünïcödé straße ﬁ 中文 😀\u00a0nbsp\x1c sep", "mail bob.o@mail.example.com, +1 (555) 010-9999 and 4539 1488 0343 6467 from 10.0.0.255 or 10.0.0.256", "a@b.c_d@e.f.g 1.2.3.4.5.6.7.8", "9" * 3_000 + "@", "<|endoftext|> hi <|startoftext|>'s 12", "%%% $$$ &&& | | a b c d e f g h",
]


@pytest.fixture(scope="module")
def docs(spark):
    """Ids in no order, some repeated or null; extra columns carry names that the operators use themselves."""
    ids = [7, 3, 5, 9, 4, 8, 30, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, None]
    rows = [(i, t, "s" + str(k % 3) if k % 7 else None, k, "mine") for k, (i, t) in enumerate(zip(ids, TEXTS))]
    rows += [rows[6], rows[0]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n int, media string").repartition(3).cache()


def collected(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def counted(df, *columns):
    return Counter(collected(df, *columns))


# Mixing


def test_mixing_inverts_the_poisson_distribution(docs):
    weights = {"s0": 2.0, "s1": 0.0, None: 1.0}
    out = poisson_mixing.mix(docs, weights=weights, default_weight=1.0)
    rows = collected(docs, "doc_id", "source")
    size = Counter(s for _, s in rows)
    total = sum(weights.get(s, 1.0) for s in size)
    want = Counter()
    for i, s in rows:
        rate = weights.get(s, 1.0) / total * len(rows) / size[s]
        u = int(hashlib.md5(f"42:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
        k, p, cdf = 0, math.exp(-rate), math.exp(-rate)
        while rate and cdf <= u:
            k += 1
            p *= rate / k
            cdf += p
        want[(i, s)] += k
    assert counted(out, "doc_id", "source") == +want
    assert out.columns == [*docs.columns, "copy"]
    assert collected(out, "doc_id", "copy") == collected(poisson_mixing.mix(docs.repartition(5), weights=weights, default_weight=1.0), "doc_id", "copy")


def test_mixing_reaches_the_target_rates_and_survives_large_ones(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "rare").otherwise("hot").alias("source"))
    n = dict(collected(poisson_mixing.mix(many, weights={"rare": 1, "hot": 1}, shuffle=False).groupBy("source").count(), "source", "count"))
    assert abs(n["rare"] - 10_000) < 400 and abs(n["hot"] - 10_000) < 400
    few = many.limit(20)
    assert abs(poisson_mixing.mix(few, budget=40_000, shuffle=False).count() - 40_000) < 2_000
    assert poisson_mixing.mix(many.limit(0)).count() == 0


def test_mixing_takes_time_in_proportion_to_the_rate(spark):
    """One row at a mean of a million copies; the distribution's list has as many entries."""
    import time

    begin = time.perf_counter()
    n = poisson_mixing.mix(spark.createDataFrame([(1, "a")], "doc_id bigint, source string"), budget=1_000_000, shuffle=False).count()
    assert abs(n - 1_000_000) < 6_000 and time.perf_counter() - begin < 20


# Audio


def test_audio_is_lossless_and_equal_for_equal_texts(docs):
    out = audio.analyse(audio.store(docs)).collect()
    assert len(out) == docs.count()
    features = {}
    for r in out:
        data = (r["text"] or "").encode()
        padded = data + b"\xff" * (-len(data) % 576 if data else 576)
        assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (len(data), len(padded), zlib.crc32(padded[-32:]))
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest()
        assert audio.samples_of(bytes(r["media"]))[0] == padded and r["media_bytes"] == len(r["media"])
        assert features.setdefault(r["text"] or "", bytes(r["features"])) == bytes(r["features"])
        table = audio.tensors_from(bytes(r["features"]))
        assert table.schema.field("log_mel").type.shape == [audio.FRAMES, audio.MELS]
        assert all(a < b for a, b in zip(table.column("start_s").to_pylist(), table.column("end_s").to_pylist()))
    assert audio.analyse(audio.store(docs.limit(0))).count() == 0


@pytest.mark.parametrize(("up", "down"), [(audio.UP, audio.DOWN), (1, 2), (2, 1), (5, 3), (147, 160)])
def test_resampling_equals_direct_convolution(up, down):
    import numpy as np

    x = np.random.default_rng(3).normal(size=4_000).astype(np.float32)
    half = audio.HALF_TAPS * max(up, down)
    k = np.arange(-half, half + 1)
    taps = np.sinc(k / max(up, down)) / max(up, down) * np.kaiser(2 * half + 1, 8.0) * up
    between = np.zeros(x.size * up)
    between[::up] = x
    want = np.convolve(between, taps)[half::down][: x.size * up // down]
    assert audio.UP > 1 and len(audio.phases(audio.UP, audio.DOWN)) == audio.UP  # the query's own ratio has several phases
    assert np.abs(audio.resample(x, 0, want.size, up, down) - want).max() < 1e-5
    assert np.abs(audio.resample(x, 501, 1_001, up, down) - want[501:1502]).max() < 1e-5


def test_stored_features_equal_a_plain_computation():
    """Frames, mel energies, segments and spans of one file, step by step."""
    import numpy as np

    data = bytes(rng.randrange(256) if 4_000 < k < 9_000 else 128 + rng.randrange(3) for k in range(576 * 30))
    x = (np.frombuffer(data, np.uint8) - 128.0) / 128.0
    y = audio.resample(x.astype(np.float32), 0, x.size * audio.UP // audio.DOWN).astype(np.float64)
    n = 1 + -(-(y.size - audio.WINDOW) // audio.HOP)
    y = np.r_[y, np.zeros((n - 1) * audio.HOP + audio.WINDOW - y.size)]
    frames = np.stack([y[k * audio.HOP : k * audio.HOP + audio.WINDOW] for k in range(n)])
    energy = 10 * np.log10(np.maximum((frames**2).mean(axis=1), audio.FLOOR))
    mel = np.log(np.maximum(np.abs(np.fft.rfft(frames * np.hanning(audio.WINDOW), audio.FFT)) ** 2 @ audio.mel_bank(12_000).astype(float), audio.FLOOR))
    spans, on, level = [], None, np.median(energy)
    for k, e in enumerate(energy):
        if on is None and e > level + audio.ON_DB:
            on = k
        elif on is not None and e < level + audio.OFF_DB:
            spans.append((on, k))
            on = None
    spans += [(on, n)] if on is not None else []
    table = audio.tensors_from(audio.ipc(audio.tensors(data, audio.RATE)))
    rows = [(a, min(a + audio.FRAMES, e)) for s, e in spans for a in range(s, e, audio.FRAMES)]
    assert rows and table.num_rows == len(rows)
    for k, (a, b) in enumerate(rows):
        got = table.column("log_mel").combine_chunks().to_numpy_ndarray()[k] if hasattr(table.column("log_mel").combine_chunks(), "to_numpy_ndarray") else table.column("log_mel").chunk(0).to_numpy_ndarray()[k]
        assert np.abs(got[: b - a] - mel[a:b]).max() < 0.01 and np.allclose(got[b - a :], np.log(audio.FLOOR), atol=0.001)
        assert abs(table.column("start_s")[k].as_py() - a * 0.01) < 1e-9


def test_segments_hold_until_the_lower_threshold():
    import numpy as np

    assert audio.segments(np.array([0, 0, 3, 0.5, 0, -3, 0, 0, 3], np.float32)) == [(2, 5), (8, 9)]
    assert audio.segments(np.zeros(9, np.float32)) == []


def test_frames_cover_the_last_samples():
    for k in range(1, 12):
        mels, energy, _ = audio.log_mel(b"\x80" * 576 * k, audio.RATE)
        assert len(mels) == len(energy) and (len(mels) - 1) * audio.HOP + audio.WINDOW >= 288 * k
    silent = b"\x80" * 576 * 2
    assert audio.log_mel(silent[:-20] + b"\xff\x00\xff\xff" * 5, audio.RATE)[1][-1] > audio.log_mel(silent, audio.RATE)[1][-1]


# Suffix arrays


def brute_removed(rows):
    first = {}
    key = lambda i: math.inf if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(key(i), first.get(b[k : k + 50], math.inf))
    out = Counter()
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < key(i):
                gone[k : k + 50] = b"\1" * 50
        out[(i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())] += 1
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup_equals_brute_force(docs):
    assert counted(suffix_dedup.deduplicate(docs), *COLUMNS) == brute_removed(collected(docs, "doc_id", "text"))


def test_suffix_dedup_of_names_with_very_many_fragments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", 3)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 2_000)
    line = "this line of text is found in very many of the documents here"
    rows = [(k, f"{rng.random()} {line} {rng.random()} {line[: 40 + k % 20]}{'é' * (k % 3)}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert counted(suffix_dedup.deduplicate(df), *COLUMNS) == brute_removed(rows)
    assert suffix_dedup.deduplicate(df.limit(0)).count() == 0


def test_two_stage_sorting_orders_like_plain_sorting():
    import numpy as np

    for alphabet in (b"ab", b"a", b"abc\x00\xff"):
        body = bytes(rng.choice(alphabet) for _ in range(400))
        t = np.r_[np.frombuffer(body, np.uint8).astype(np.uint16) + 1, 0].astype(np.uint16)
        order = suffix_dedup.suffix_array(t, np.ones(t.size, bool))
        suffixes = [body[i : i + 50] for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(t.size)) and suffixes == sorted(suffixes)
        prefix = suffix_dedup.common_prefixes(suffix_dedup.words(t), order)
        for k in range(1, len(order)):
            a, b = body[order[k - 1] :][:56], body[order[k] :][:56]
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[k] == same or (prefix[k] >= same == min(len(a), len(b)))


# SimHash


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: (id, fingerprint) -> smallest id of each fingerprint's component."""
    nodes = sorted({f for _, f in prints})
    root = {f: f for f in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    best = {}
    for i, f in prints:
        if i is not None:
            best[find(f)] = min(i, best.get(find(f), i))
    return {f: best.get(find(f)) for f in nodes}


def test_simhash_fingerprints_and_groups(docs):
    prints = [(i, brute_fingerprint(t)) for i, t in collected(docs, "doc_id", "text")]
    want = brute_components(prints)
    out = simhash.grouped(docs).select("_id", simhash.hex_of(F.col("fp")), "component_id")
    assert counted(out, "*") == Counter((i, f"{f:016x}", want[f]) for i, f in prints)
    assert simhash.grouped(docs.limit(0)).count() == 0


@pytest.mark.parametrize("longest", [2, 48])
def test_links_by_index_and_by_neighbours_lose_nothing(spark, monkeypatch, longest):
    monkeypatch.setattr(simhash, "MAX_POSTING", longest)
    fps = {0, 1, 3, 7, (1 << 64) - 1}
    for base in (rng.getrandbits(64) for _ in range(12)):
        for _ in range(25):
            x = base
            for b in rng.sample(range(64), rng.randrange(4)):
                x ^= 1 << b
            fps.add(x)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    prints = [(k, f) for k, f in enumerate(sorted(fps))]
    df = spark.createDataFrame([(k, signed(f)) for k, f in prints], "_id bigint, fp bigint")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    label = lambda f: found.get(signed(f), signed(f))
    want = brute_components(prints)
    groups = {}
    for _, f in prints:
        groups.setdefault(label(f), set()).add(want[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_the_tally_keeps_pairs_with_six_equal_bytes(spark):
    """Pairs with five equal bytes share one posting, pairs with six share the guaranteed number; only bits tell those apart."""
    assert len(simhash.MASKS) == 56 and simhash.GUARANTEED == 6
    share = lambda a, b: sum((a ^ b) & m == 0 for m in simhash.MASKS)
    x = rng.getrandbits(64)
    five, six, near = x ^ 0x010101, x ^ 0x0303, x ^ 0x0101
    assert (share(x, five), share(x, six), share(x, near)) == (1, 6, 6)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    pairs = [(signed(x), signed(y)) for y in (five, six, near) for _ in range(share(x, y))]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert counted(simhash.tallied(df), "a", "b") == {(signed(x), signed(near)): 1}
    # With the bit check taken away, the count filter alone still drops what shares too few postings.
    few = spark.createDataFrame([(1, 0)] * 5 + [(2, 0)] * 6, "a bigint, b bigint")
    assert counted(simhash.tallied(few), "a") == {(2,): 1}


def test_one_of_each_group_stays_whole(docs):
    kept = simhash.keep_one(docs)
    want = brute_components([(i, brute_fingerprint(t)) for i, t in collected(docs, "doc_id", "text")])
    got = [(i, want[brute_fingerprint(t)]) for i, t in collected(kept, "doc_id", "text")]
    assert kept.columns == docs.columns and len(got) == len(set(want.values())) and all(i == c for i, c in got)


def brute_similar(rows, similarity=0.8):
    """rows: (id, text) -> smallest id of each text's group, linked at this similarity of 5-word shingles."""
    def shingles(text):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
        return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    texts = sorted({t or "" for _, t in rows})
    sets, root = {t: shingles(t) for t in texts}, {t: t for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= similarity * max(len(x), len(y)) and len(x & y) >= similarity * len(x | y):
                root[find(b)] = find(a)
    best = {}
    for i, t in rows:
        if i is not None:
            best[find(t or "")] = min(i, best.get(find(t or ""), i))
    return {t: best.get(find(t)) for t in texts}


def edited(words, rng, n):
    words = list(words)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("longest", [3, 48])
def test_similar_texts_are_grouped_at_five_words_and_four_fifths(spark, monkeypatch, longest):
    """Families of edited copies, some in long postings, beside texts that share only a passage; edge cases of all texts."""
    monkeypatch.setattr(simhash, "MAX_POSTING", longest)
    own, rows = random.Random(6), []
    words = [f"w{k}" for k in range(900)]
    for family in range(12):
        base = [own.choice(words) for _ in range(own.choice([60, 150, 400]))]
        for copy in range(own.choice([2, 3, 9])):
            rows.append((len(rows), edited(base, own, own.randrange(0, max(2, len(base) // 30)))))
        rows.append((len(rows), " ".join(base[:40]) + " " + " ".join(own.choice(words) for _ in range(120))))
    rows += [(len(rows) + k, t) for k, t in enumerate([None, "", " \n", "a", "A", "one two", "one  TWO", "one two three four", rows[3][1], rows[3][1].upper()])]
    rows += [(None, rows[5][1]), (None, "nobody else")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = brute_similar(rows)
    got = simhash.similar(df)
    assert counted(got, "_id", "component_id") == Counter((i, want[t or ""]) for i, t in rows)
    kept = collected(simhash.keep_one(df, groups_of=simhash.similar), "doc_id", "text")
    assert sorted(str(i) for i, _ in kept) == sorted(str(c) for c in {want[t or ""] for _, t in rows})
    assert simhash.similar(df.limit(0)).count() == 0


def test_similar_documents_of_a_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = brute_similar(rows)
    got = dict(collected(simhash.similar(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")), "_id", "component_id"))
    assert got == {i: want[t or ""] for i, t in rows}


# Urls


URLS = [None, "", "no scheme", "http://EXAMPLE.com/en/7?x=1", "https://a.example.com/en/12", "http://x.com/en/3#t", "http://com/en/", "http://notcom/en/1", "ftp://b.example.net/de/8/9", "http://net/de/", "http://net", "http://org?a=/es/", "a://b://c/es/", "http://www.site.org/es/5", "http://q.org/fr/" + "9" * 3_000]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_url_rules_and_trees(spark):
    made = [f"http://h{k % 9}.{'com' if k % 2 else 'net'}/{'en' if k % 3 else 'de'}/{k}" for k in range(300)]
    rows = [(k, u, "clash") for k, u in enumerate(URLS + made + URLS[3:5])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string").repartition(3)
    out = url_filter.judge(df, RULES, rounds=3).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, verdict = brute_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in {"allow", "block"}
        assert verdict is None or r["verdict"] == verdict
    assert url_filter.judge(df.limit(0), RULES).count() == 0
    assert counted(url_filter.judge(df.where("url like '%notcom%'"), RULES), "verdict") == {("allow",): 1}


def test_url_trees_learn_what_the_features_tell(spark):
    rows = [(f"http://{'spam-farm-' * (k % 2)}{rng.randrange(10**6)}.example/{k}", k % 2) for k in range(1_000)]
    df = spark.createDataFrame(rows, "url string, y int")
    host, path = url_filter.host_and_path(df["url"])
    df = df.withColumns({"host": host, "path": path, "held": F.pmod(F.xxhash64("url"), F.lit(4)) == 0})
    model = url_filter.fit(df.where("not held"), "url", "y", "host", "path", rounds=5)
    right = model.block_probability(df.where("held"), "url", "host", "path").select(((F.col("block_probability") > 0.5).cast("int") == F.col("y")).cast("int").alias("r"))
    assert right.agg(F.avg("r")).first()[0] > 0.97


# Language model


def plain_log_prob(model, words, text, shares):
    """Log-probability of a text by loops and dictionaries: every word by the two words on each side of it."""
    import numpy as np

    w = {k: v.astype(float) for k, v in model.w.items()}
    ids = {x: k for k, x in enumerate(words)}
    number = lambda x: ids.get(x, lm_scoring.WORDS + (xxhash.xxh64_intdigest(x.encode(), 42) >> 54))
    tokens = text.lower().split()
    line = [lm_scoring.EDGE] * 2 + [number(x) for x in tokens] + [lm_scoring.EDGE] * 2
    total = 0.0
    for k, x in enumerate(tokens, 2):
        h = np.tanh(w["bias"] + sum(w["context"][p][line[k + d]] for p, d in enumerate((-2, -1, 1, 2))))
        of, place = divmod(line[k], lm_scoring.CLASSES)
        a = np.array([w["class_bias"][c] + h @ w["classes"][c] for c in range(lm_scoring.CLASSES)])
        g = np.tanh(h + w["given"][of])
        b = np.array([w["place_bias"][of][m] + g @ w["places"][m] for m in range(lm_scoring.CLASSES)])
        total += a[of] - np.log(np.exp(a).sum()) + b[place] - np.log(np.exp(b).sum()) + (0 if x in ids else math.log(shares(x)))
    return total


def test_pseudo_likelihood_sums_conditional_probabilities(docs):
    model, words = lm_scoring.fit(docs)
    out = {r["text"]: (r["n_tokens"], r["log_prob"], r["mean_log_prob"]) for r in lm_scoring.score(docs, model, words).collect()}
    assert out[None] == out[""] == (0, 0.0, None)
    for text in (SENTENCE, "a", "one two three", SENTENCE.upper()):
        assert out[text][0] == len(text.split()) and abs(out[text][1] - plain_log_prob(model, words, text, None)) < 0.01
    assert lm_scoring.score(docs.limit(0), *lm_scoring.fit(docs.limit(0))).count() == 0


def test_probabilities_of_all_ids_sum_to_one(docs):
    import numpy as np

    model, _ = lm_scoring.fit(docs, rounds=1)
    sides = np.repeat(np.array([[3], [5], [4096], [9]]), lm_scoring.VOCABULARY, axis=1)
    assert abs(np.exp(model.log_prob(sides, np.arange(lm_scoring.VOCABULARY)).astype(float)).sum() - 1) < 1e-3


def test_words_of_one_id_have_their_own_probabilities(spark):
    """With more words than the network has ids, p(word) is p(id) times the word's share of the id's tokens."""
    bucket = lambda w: xxhash.xxh64_intdigest(w.encode(), 42) >> 54
    rare = [w for w in (f"w{k}" for k in range(20_000)) if bucket(w) == 7][:4]
    often, new = rare[:3], rare[3]
    common = " ".join(f"c{k}" for k in range(lm_scoring.WORDS))
    corpus = spark.createDataFrame([(common,)] * 6 + [(f"{often[0]} {often[0]} {often[0]} {often[0]} {often[1]}",), (often[2],)], "text string")
    model, words = lm_scoring.fit(corpus, rounds=0)
    assert not set(rare) & set(words) and len(words) == lm_scoring.WORDS
    out = spark.createDataFrame([(w,) for w in rare] + [(f"{often[0]} c1 {often[0]}",)], "text string")
    p = {r["text"]: r["log_prob"] for r in lm_scoring.score(out, model, words, counted=lm_scoring.counts(corpus)).collect()}
    assert abs(p[often[0]] - p[often[1]] - math.log(4)) < 0.002 and abs(p[often[1]] - p[often[2]]) < 0.002
    assert abs(p[new] - p[often[2]]) < 0.002
    shares = {often[0]: 4 / 7, often[1]: 1 / 7, often[2]: 1 / 7, new: 1 / 7}
    for text, value in p.items():
        assert abs(value - plain_log_prob(model, words, text, shares.get)) < 0.01


def test_training_takes_every_position_once():
    for n in (0, 1, 2, 9_000):
        assert sorted(x for k in range(lm_scoring.ROUNDS) for x in lm_scoring.positions(n, 3, k).tolist()) == list(range(n))


def test_scores_do_not_depend_on_partitioning(docs, spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 5_000)  # several shards, and several steps of averaging
    monkeypatch.setattr(lm_scoring, "FAN_IN", 3)
    some = docs.select("n", "text")
    results = {tuple(sorted(collected(lm_scoring.fit_and_score(some.repartition(k), keep_text=False), "n", "log_prob"))) for k in (1, 7)}
    assert len(results) == 1


def test_lines_of_long_texts_keep_their_neighbours(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(lm_scoring, "CHUNK", 7)
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(text,), (text,), ("w1",), (None,)], "text string")
    seen, names = lm_scoring.encoded(df, [f"w{k}" for k in range(40)])
    rows = [(np.frombuffer(bytes(r["line"]), np.int16).tolist(), r["times"]) for r in lm_scoring.shards(seen, names, 81).collect()]
    whole = [4096] * 2 + list(range(40)) + [4096] * 2
    assert sorted(rows) == sorted([(whole[k : k + 11], 2) for k in range(0, 40, 7)] + [([4096, 4096, 1, 4096, 4096], 1)])


def test_language_model_learns_context(spark):
    import numpy as np

    texts = [(" ".join(x for _ in range(60) for x in rng.choice([("red", "fox", "ran"), ("blue", "cow", "sat")])),) for _ in range(300)]
    df = spark.createDataFrame(texts, "text string").repartition(3)
    prior, words = lm_scoring.fit(df, rounds=0)
    model, _ = lm_scoring.fit(df, rounds=5)
    mean = lambda m: lm_scoring.score(df, m, words).agg(F.avg("mean_log_prob")).first()[0]
    assert mean(model) > mean(prior) + 0.5
    assert np.isfinite(mean(model))


# Pages


PAGE = "<html><head><title>T</title></head><body><nav><ul><li><a href='#'>m</a></li></ul></nav><div class='cookie-notice'>c</div>{}<aside>s</aside><footer>f</footer></body>"


def test_main_text_follows_the_host_wrapper(spark):
    article = "<article><h1>Head &amp; more</h1><p>one\n <b>two</b><br>three<p>x &lt; y<ul><li>i</li><li>j</ul><div id='comments'><p>nice</p></div><form>z</form><script>var a='</p>';</script></article>"
    text = "Head & more\n\none two three\n\nx < y\n\ni\n\nj"
    rows = [(k, f"http://h.com/{k}", PAGE.format(article), "text of mine") for k in range(5)]
    rows += [(5, None, None, None), (6, "x", "", None), (7, "http://h.com/7", "<p>cut <b>off</b> here<p", None), (8, "http://d.com/", "<div>" * 4_000 + "deep" + "</div>" * 4_000, None)]
    rows += [(9 + k, f"http://plain.com/{k}", f"<div>Site name</div><div>Story number {k}</div>", None) for k in range(4)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string").repartition(4)
    out = dict(collected(html_extract.main_text(df), "page_id", "text"))
    assert {out[k] for k in range(5)} == {text}
    assert (out[5], out[6], out[7], out[8]) == ("", "", "cut off here", "deep")
    assert [out[9 + k] for k in range(4)] == [f"Story number {k}" for k in range(4)]  # the site's name is template
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_state_classes_and_marked_articles_are_not_left_out(spark):
    article, rest = "<article class='post has-ads'><p>Text of {}</p></article>", "<div class='cookie-bar'>c</div><div id='comments'><article class='comment'>said</article></div>"
    around = ["<body class='no-sidebar'>{}", "<body class='single-post comments-open'>{}", "<div class='content with-header'>{}</div>", "<main class='has-sidebar'>{}</main>", "<div class='right sidebar'>{}</div>", "<main class='menu'><p>Text of {{}}</p></main>"]
    rows = [(k, f"http://h{k}.com/", a.format(article).format(k) + rest) for k, a in enumerate(around)]
    out = html_extract.main_text(spark.createDataFrame(rows, "page_id int, url string, html string"))
    assert dict(collected(out, "page_id", "text")) == {k: f"Text of {k}" for k in range(len(around))}


def test_template_texts_are_counted_exactly(spark):
    """A notice on few of the slot's many texts, and lists too long for alignment whose items have ids of their own."""
    notice = [f"<div id='n{k}'>Shop closed on Monday</div>" if k % 8 == 0 else "" for k in range(200)]
    rows = [(k, f"http://many.com/{k}", "".join(f"<div id='x{k}_{j}'>Item {k} of {j}</div>" for j in range(5)) + notice[k]) for k in range(200)]
    rows += [(200 + k, f"http://long.com/{k}", "".join(f"<div class='c{k}x{j}'>{k} of {j}</div>" for j in range(320)) + "<p>Site name</p>") for k in range(4)]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(parts, "page_id")
        out = dict(collected(html_extract.main_text(df), "page_id", "text"))
        assert all(out[k] == "\n\n".join(f"Item {k} of {j}" for j in range(5)) for k in range(200))
        assert all(out[200 + k] == "\n\n".join(f"{k} of {j}" for j in range(320)) for k in range(4))


def test_copies_and_rare_quotes_are_no_template(spark):
    copied, quote = "<div>Whole story</div><div>in two parts</div>", "<div>A quoted paragraph</div>"
    rows = [(k, None if k < 5 else f"http://copy.com/{k}", copied) for k in range(10)]
    rows += [(10 + k, f"http://big.com/{k}", f"<div>Site name</div><div>Story {k}</div>{quote if k < 4 else ''}") for k in range(60)]
    rows += [(100 + k, f"http://same.com/{k}", f"<div>Only this</div><p><a href='{k}'>link</a></p>") for k in range(4)]
    out = dict(collected(html_extract.main_text(spark.createDataFrame(rows, "page_id int, url string, html string").repartition(3)), "page_id", "text"))
    assert {out[k] for k in range(10)} == {"Whole story\n\nin two parts"}
    assert [out[10 + k] for k in range(60)] == [f"Story {k}" + "\n\nA quoted paragraph" * (k < 4) for k in range(60)]
    assert {out[100 + k] for k in range(4)} == {"Only this"}


def test_wrappers_fold_repeats_and_mark_options():
    wrapper = html_extract.infer(["<ul><li>a<li>b</ul><p>x", "<ul><li>c</ul><h2>t</h2><p>x"])
    kinds = {}

    def walk(w):
        kinds[w[0]] = (w[1], w[2])
        for c in w[3]:
            walk(c)

    walk(wrapper)
    assert kinds["li"][1] and kinds["h2"][0] and not kinds["p"][0]
    assert len(wrapper[5]) == 2  # different pages


UNMARKED = "<html><body><div><div><a href='/a'>Home</a></div><div><a href='/b'>News</a></div></div><div>The Daily Sample</div>{notice}<div><div>{title}</div>{body}<div>Share this with friends</div></div><div>Advice {ad}</div><div>Printed by Sample House</div></body></html>"


def test_unmarked_pages_are_read_through_the_wrapper_alone(spark):
    """No article element, no class names: what never varies is template, and most of what varies is the article."""
    story = lambda k: [f"Paragraph {k} {j} " + " ".join(rng.choice(SENTENCE.split()) for _ in range(20)) for j in range(1 + k % 4)]
    texts = {k: story(k) for k in range(12)}
    page = lambda k: UNMARKED.format(title=f"Title {k}", body="".join(f"<p>{x}</p>" for x in texts[k]), ad=k * 7, notice="<ul><li>Closed on Monday</li></ul>" if k % 4 == 0 else "")
    rows = [(k, f"http://h.com/{k}", page(k)) for k in range(12)] + [(100 + k, "http://h.com/0", page(0)) for k in range(5)]
    out = dict(collected(html_extract.main_text(spark.createDataFrame(rows, "page_id int, url string, html string").repartition(4)), "page_id", "text"))
    want = {k: "\n\n".join([f"Title {k}", *texts[k]]) for k in range(12)}
    assert {k: out[k] for k in range(12)} == want and all(out[100 + k] == want[0] for k in range(5))
    alone = html_extract.extract(page(3), None)
    assert "The Daily Sample" in alone and alone != want[3]  # the page by itself cannot tell


def test_given_pages_without_their_marks_need_the_wrapper():
    """Article, menu and footer elements and all class names taken away: the hosts' wrappers still find the articles."""
    import pandas as pd

    plain = lambda t: re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(article|nav|footer)\b[^>]*>", r"<\1div>", t))
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    by = {}
    for url, page in zip(pages["url"], pages["html"]):
        by.setdefault(url.split("/")[2] if url and "//" in url else "", []).append(page or "")
    found = alone = n = 0
    for group in by.values():
        if len({*group}) >= html_extract.MIN_PAGES:
            wrapper = html_extract.ready(html_extract.infer(map(plain, group)))
            for page in group:
                want = html_extract.extract(page, None)
                n += 1
                found += html_extract.extract(plain(page), wrapper) == want
                alone += html_extract.extract(plain(page), None) == want
    assert n > 200 and found == n and alone == 0


def test_alignment_pairs_in_order_and_needs_no_short_lists():
    pairs = [*html_extract.paired([*"abcad"], [*"bacd"])]
    assert [i for i, _ in pairs if i is not None] == [*range(5)] and [j for _, j in pairs if j is not None] == [*range(4)]
    assert sum(i is not None and j is not None for i, j in pairs) == 3
    left, right = [f"x{k}" for k in range(50_000)], [f"x{k}" for k in range(0, 50_000, 2)]
    assert sum(i is not None and j is not None for i, j in html_extract.paired(left, right)) == 25_000


def test_depth_of_nesting_changes_no_text(monkeypatch):
    page = "<div>" * 30 + "<article><h1>T</h1><div><div><p>one</p><nav>x</nav><p>two</p></div></div></article>tail" + "</div>" * 30
    want = html_extract.extract(page, None)
    monkeypatch.setattr(html_extract, "MAX_DEPTH", 10)
    assert html_extract.extract("<div>" * 30 + "one<p>two</p><div>three</div>", None) == "one\n\ntwo\n\nthree" and want == "T\n\none\n\ntwo"


# Personal data


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        return sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d))) % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_base_spans_equal_the_patterns(docs):
    out = pii.annotate(docs).select("text", "base_spans", "media").collect()
    assert len(out) == docs.count() and {r["media"] for r in out} == {"mine"}
    for r in out:
        assert [tuple(s) for s in r["base_spans"]] == brute_spans(r["text"])
    assert pii.annotate(docs.limit(0)).count() == 0


def test_contexts_discover_identifiers_and_leave_others(spark):
    rows = [(k, f"we wrote: contact address 10.{k}.7.9 today and bought {k} apples") for k in range(40)]
    rows += [(100, "then contact address 999.1.1.1 came up"), (101, "he ate 12 pears at 5pm"), (102, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = {r["doc_id"]: [(s["start"], s["end"]) for s in r["found_spans"]] for r in pii.annotate(df).collect()}
    assert out[100] == [(21, 30)]
    assert all(not v for k, v in out.items() if k != 100)
    masked = dict(collected(pii.redact(df), "doc_id", "text"))
    assert masked[100] == "then contact address [ID] came up" and masked[3] == "we wrote: contact address [IP] today and bought 3 apples"
    assert masked[101] == rows[41][1] and masked[102] is None


def test_contexts_are_the_words_to_the_left_and_found_values_seed_others(spark):
    phones = [f"+1 (555) 010-{1000 + k}" for k in range(20)]
    rows = [(k, f"{p} and more, then call me {p} or {k}0") for k, p in enumerate(phones)]
    rows += [(30 + k, f"call me x{k}-77-abc") for k in range(4)] + [(40 + k, f"badge holder x{k}-77-abc") for k in range(4)]
    rows += [(50, "2019 2020 2021"), (51, "2024 was 12 34 56"), (52, "badge holder q9-12-zz")]
    out = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id int, text string").repartition(3)).collect()}
    assert out[50] == rows[28][1] and out[51] == rows[29][1]
    assert all(out[30 + k] == "call me [ID]" and out[40 + k] == "badge holder [ID]" for k in range(4))
    assert out[52] == "badge holder [ID]" and out[3] == "[PHONE] and more, then call me [PHONE] or 30"


def test_keys_drawn_at_random_are_found_by_their_pattern(spark):
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(k, f'he wrote token = "{secret()}" in line {k}') for k in range(6)] + [(9, 'then token = "short7" and no more'), (10, f"checksum {secret()} of the file")]
    out = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert all(out[k] == f'he wrote token = "[ID]" in line {k}' for k in range(6)) and out[9] == 'then token = "[ID]" and no more'
    assert out[10] == rows[-1][1]  # one key in a context of its own is no pattern


def test_spans_of_very_long_texts_take_time_in_proportion(spark):
    import time

    text = lambda n: " ".join(f"w{k % 97} {k} a{k}@b.com" if k % 3 == 0 else f"x{k}" for k in range(n))
    times = {}
    for n in (2_000, 20_000, 100_000):
        df = spark.createDataFrame([(text(n),)], "text string")
        start = time.perf_counter()
        row = pii.annotate(df).first()
        times[n] = time.perf_counter() - start
        assert len(row["base_spans"]) == sum(1 for k in range(n) if k % 3 == 0)
    assert times[100_000] < 60 and times[100_000] < 15 * max(times[20_000], 2)


def test_overlapping_spans_and_marks_in_the_text(spark):
    rows = [(0, "\ue000 call +4539 1488 0343 6467 or \ue000 5 at 1.2.3.4@host.org"), (1, "+1 (555) 010-9999+1 (555) 010-9998")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    for r in pii.annotate(df).collect():
        assert [tuple(x) for x in r["base_spans"]] == brute_spans(r["text"])
    masked = dict(collected(pii.redact(df), "doc_id", "text"))
    assert masked[0] == "\ue000 call +[CARD] or \ue000 5 at [EMAIL]" and masked[1] == "[PHONE][PHONE]"


# Byte pairs


def test_bpe_equals_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t in collected(docs, "doc_id", "text"):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert counted(bpe.summaries(docs, tokenizer_path()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    for r in bpe.tokenised(docs, tokenizer_path()).collect():
        assert r["text"] == library.decode(r["token_ids"], skip_special_tokens=False) and r["n_tokens"] == len(r["token_ids"])
    assert bpe.encode(docs.limit(0), tokenizer_path()).count() == 0


# Quality


def brute_statistics(text):
    t = text or ""
    words = WORD.findall(t)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_statistics_equal_brute_force(docs):
    out = quality_rules.judge(docs, []).collect()
    assert len(out) == docs.count()
    for r in out:
        n = brute_statistics(r["text"])
        assert tuple(r[k] for k in quality_rules.BASE) == n
        failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
        assert (r["base_failed"], r["kept"]) == (failed, not failed)
    assert quality_rules.judge(docs.limit(0), []).count() == 0


def test_decision_list_covers_the_bad_and_spares_the_good(spark):
    words = SENTENCE.split()
    text = lambda bad: " ".join(rng.choice(words) + ("%%%" if bad == 1 else "") for _ in range(60)).upper() if bad == 2 else " ".join(rng.choice(words) + ("%%%" if bad == 1 else "") for _ in range(60))
    rows = [(k, text(k % 3), int(k % 3 == 0)) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, q int")
    labels = df.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("q")).alias("quality"))
    clauses = quality_rules.learn_from(df, labels)
    assert 1 <= len(clauses) <= 3
    assert counted(quality_rules.judge(df, clauses), "q", "kept") == {(1, True): 200, (0, False): 400}
    assert quality_rules.learn_from(df, labels.where("quality = 1")) == [] and quality_rules.learn_from(df, labels.limit(0)) == []


# All operators: clashing columns, nulls, empty tables


CLASHES = ["_cdf", "_times", "_source", "_mixed_source", "found", "_tokens", "_key", "_found_key", "_wrapper", "_templates", "_host", "_depth", "_suffix", "_features", "_probability", "rule_verdict", "_words", "_lines", "_upper", "_row", "_ids", "_rare", "_sum", "_own", "_text", "_row_id", "_nth", "row", "_source_value", "_text_to_encode", "base_spans", "word", "h", "a.b", "back`tick", "_named_0"]
OPERATORS = {
    "mixing": lambda df: poisson_mixing.mix(df),
    "audio": lambda df: audio.analyse(audio.store(df)),
    "simhash": lambda df: simhash.keep_one(df),
    "urls": lambda df: url_filter.judge(df, RULES, rounds=2),
    "language model": lambda df: lm_scoring.fit_and_score(df),
    "pages": lambda df: html_extract.main_text(df, page="html", text="main"),
    "personal data": lambda df: pii.redact(df),
    "byte pairs": lambda df: bpe.encode(df, tokenizer_path()),
    "quality": lambda df: quality_rules.judge(df, [quality_rules.Clause((quality_rules.Literal("symbol_share", True, 0.5),), 1, 0)]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_of_any_name_keep_their_values(spark, name):
    texts = [None, "", SENTENCE, SENTENCE, "mail a@b.org now", "one two three four five six seven eight nine ten eleven"]
    urls = ["http://x.com/en/1", "http://example.net/de/3", None, "http://x.org/a", "http://y.net/de/1", "http://y.net/de/1"]
    rows = [(k, t, "s" + str(k % 2), u, f"<p>{t}</p>" if t else t, *[f"{c} {k}" for c in CLASHES]) for k, (t, u) in enumerate(zip(texts, urls))]
    schema = "doc_id bigint, text string, source string, url string, html string, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHES)
    df = spark.createDataFrame(rows + rows[4:5], schema)
    out = OPERATORS[name](df)
    kept = [c for c in CLASHES if c in out.columns]
    assert kept == CLASHES or name == "pages"
    for r in out.collect():
        assert all(r[c] == f"{c} {r['doc_id']}" for c in CLASHES)
    assert OPERATORS[name](df.limit(0)).count() == 0


def test_suffix_dedup_takes_other_columns_without_harm(spark):
    df = spark.createDataFrame([(1, SENTENCE, "x", 5), (2, SENTENCE, "y", 6)], "doc_id bigint, text string, _id string, n_bytes int")
    assert counted(suffix_dedup.deduplicate(df), *COLUMNS) == brute_removed(collected(df, "doc_id", "text"))


CONTRACTS = {
    "op2_audio": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op3_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op4_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op7_html": "page_id bigint, url string, text string, n_chars bigint",
    "op8_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op9_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_registered_queries_hold_their_contracts(spark, name):
    """Columns, types, every row of the table once, and the values that the contract fixes, by brute force."""
    data = "/root/testdata/sf0.001"
    out = queries.QUERIES[name](spark, data)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [tuple(x.split(" ")) for x in CONTRACTS[name].split(", ")]
    of, key = ("pages", "page_id") if "page_id" in out.columns else ("documents", "doc_id")
    source = {r[key]: r for r in spark.read.parquet(f"{data}/{of}.parquet").collect()}
    rows = out.collect()
    assert sorted(r[key] for r in rows) == sorted(source)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    if name == "op3_suffix_dedup":
        assert Counter(map(tuple, rows)) == brute_removed([(k, r["text"]) for k, r in source.items()])
    if name == "op4_simhash":
        want = brute_components([(k, brute_fingerprint(r["text"])) for k, r in source.items()])
        assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {(k, f"{(f := brute_fingerprint(r['text'])):016x}", want[f]) for k, r in source.items()}
    for r in rows:
        given = source[r[key]]
        text = (given["text"] or "") if of == "documents" else None
        if name == "op2_audio":
            data_ = text.encode() + b"\xff" * (-len(text.encode()) % 576 if text else 576)
            assert tuple(r)[1:5] == (len(text.encode()), len(data_), sha(data_), zlib.crc32(data_[-32:]))
        if name == "op5_url_filter":
            host, path, rule, verdict = brute_rule(given["url"])
            assert tuple(r)[1:4] == (host, path, rule) and r["verdict"] in {verdict or "allow", verdict or "block"}
        if name == "op7_html":
            assert r["url"] == given["url"] and r["n_chars"] == len(r["text"])
        if name == "op8_pii":
            spans = brute_spans(text)
            line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            assert tuple(r)[1:6] == (*[sum(x[0] == k for x in spans) for k in pii.KINDS], sha(line.encode())) and r["spans"].startswith(line)
        if name == "op10_quality_rules":
            n = brute_statistics(text)
            failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
            assert tuple(r)[1:7] == (*n, failed) and not (failed and r["kept"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    found = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in found.description]
    want = Counter(found.fetchall())
    out = queries.QUERIES[name](spark, data)
    assert sorted(out.columns) == sorted(columns) and counted(out, *columns) == want
