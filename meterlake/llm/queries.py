"""The registered queries of the text operators, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bpe, conversation_repair, filter_audit, html_extract, lm_scoring, packing, pii, poisson_mixing, quality_rules, simhash, suffix_dedup, url_filter
from .common import table

RULES = (
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to weights of their sources' sizes to the power 0.5."""
    return poisson_mixing.mix(table(spark, sf_dir, "documents"))


def op2_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = audio.store(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    out = audio.analyse(stored, keep_media=False)
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.sha2("features", 256).alias("feature"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(F.col("_id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.fit_and_score(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("bigint")
    return out.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(line(F.col("base_spans")), 256).alias("base_sha256"), line(F.concat("base_spans", "found_spans")).alias("spans"))


def tokenizer_path() -> str:
    """The public tokenizer that the BPE queries use; installed with the tokenizer files, not kept here."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.summaries(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clauses = quality_rules.learn_from(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, clauses).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def packing_tokenizer_path() -> str:
    """The public tokenizer that packing uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), packing_tokenizer_path(), keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation_repair.repair(rows, "times")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


# What SQL can say of three of the queries, with their operators' functions, for a check by SQL.


def urls_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and longest rule of every url, as in op5_url_filter."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(pages["url"])
    return url_filter.with_rule(pages.withColumns({"host": host, "path": path}), RULES, "host", "path").select("page_id", "host", "path", "rule")


def personal_data_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans by kind in every text, as in op8_pii."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = docs.select("doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("bigint")
    return spans.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS])


def text_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the base rule of every text, as in op10_quality_rules."""
    docs = quality_rules.statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", *quality_rules.BASE, quality_rules.base_failed().alias("base_failed"))


QUERIES = {"op1_mixing": op1_mixing, "op2_audio": op2_audio, "op3_suffix_dedup": op3_suffix_dedup, "op4_simhash": op4_simhash, "op5_url_filter": op5_url_filter, "op6_lm_scoring": op6_lm_scoring, "op7_html": op7_html, "op8_pii": op8_pii, "op9_bpe": op9_bpe, "op10_quality_rules": op10_quality_rules, "op11_packing": op11_packing, "op12_repair": op12_repair, "op13_filter_audit": op13_filter_audit, "urls_by_rule": urls_by_rule, "personal_data_counts": personal_data_counts, "text_statistics": text_statistics}
_FITS = "WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}'"
_SPACE, _NOT_SPACE = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
#: Mixing and the filter audit are the operators that SQL expresses whole; tests hold the others against brute force.
ORACLES: dict[str, str] = {
    "urls_by_rule": f"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u)
SELECT page_id, host, path, CASE {" ".join(_FITS.format(h=h, p=p) for h, p in (("example.com", "/en/7"), ("example.net", "/de/8"), ("com", "/en/"), ("net", "/de/"), ("org", "/es/")))} END AS rule FROM h""",
    "personal_data_counts": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'))::BIGINT AS n_email,
 len(list_filter(regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda x: list_max(list_transform(string_split(x, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 999))) <= 255))::BIGINT AS n_ip,
 len(list_filter(regexp_extract_all(t, '[0-9]([ -]?[0-9])+'), lambda x: length({_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(length({_DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN substr(reverse({_DIGITS}), i + 1, 1)::INTEGER
  ELSE (2 * substr(reverse({_DIGITS}), i + 1, 1)::INTEGER) // 10 + (2 * substr(reverse({_DIGITS}), i + 1, 1)::INTEGER) % 10 END)) % 10 = 0))::BIGINT AS n_card,
 len(list_filter(regexp_extract_all(t, '\+[0-9][ ().0-9-]+[0-9]'), lambda x: length({_DIGITS}) BETWEEN 8 AND 15))::BIGINT AS n_phone FROM d""",
    "text_statistics": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_NOT_SPACE}')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)), rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(5)) AS k) GROUP BY 1),
b AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars, (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b""",
    "op13_filter_audit": rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents), w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS words FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
f AS (SELECT w.doc_id, part, concat(CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END, CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(t) THEN 'C' END,
 CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL), x AS (SELECT unnest(string_split('ABCDE', '')) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest(range(1, 6))::INTEGER AS step)),
r AS (SELECT part, filter_order, step, f, sum(n) FILTER (WHERE NOT late AND NOT fail) AS kept, sum(n) FILTER (WHERE NOT late AND fail) AS removed, sum(n) FILTER (WHERE late AND fail) AS redundant, sum(n) FILTER (WHERE fails = f) AS unique_fails,
 sum(n) FILTER (WHERE NOT late AND fail AND good = 1) AS good_lost, sum(n) FILTER (WHERE NOT late AND fail AND toxic = 1) AS toxic_lost FROM (SELECT *, contains(fails, f) AS fail, translate(fails, before, '') <> fails AS late FROM c, s) GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
 coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley FROM r""",
    "op1_mixing": """WITH s AS (SELECT source, count(*)::DOUBLE AS n FROM documents GROUP BY 1), t AS (SELECT sum(pow(n, 0.5)) AS w, sum(n) AS n FROM s),
r AS (SELECT source, pow(s.n, 0.5) / t.w * t.n / s.n AS rate FROM s, t),
c AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM (SELECT source, rate, unnest(range(ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM r)),
u AS (SELECT d.*, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM documents d),
n AS (SELECT u.*, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cdf <= u.u) AS times FROM u)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, times + 1))::INTEGER AS copy FROM n""",
}
