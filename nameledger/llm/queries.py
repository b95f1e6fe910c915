"""The registered queries of the training-data operators, with SQL where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nameledger.llm.bpe import encode_documents
from nameledger.llm.chat import format_conversations
from nameledger.llm.common import table
from nameledger.llm.lines import dedup_report
from nameledger.llm.packing import pack_documents
from nameledger.llm import quality
from nameledger.llm.quality import judge
from nameledger.llm.repair import damaged, repair_report
from nameledger.llm.repeats import remove_repeats
from nameledger.llm.secrets import scan
from nameledger.llm.simhash import near_groups
from nameledger.llm.spelling import group_variants, run_counts
from nameledger.llm import urls
from nameledger.llm.warc import archive_pages
from nameledger.llm.winnowing import fingerprint_documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and packed into sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back; repeated payloads are revisits."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"]
    return archive_pages(table(spark, sf_dir, "pages")).select(columns)


OP2_SQL = """
WITH stored AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, max(page_id) AS response FROM stored WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to, true AS verified
FROM stored LEFT JOIN first USING (payload_digest)
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by byte-level BPE ranks and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and whether the rules keep it."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(table(spark, sf_dir, "documents")).select(columns)


def _op4_sql() -> str:
    lists = {**quality.COMMON_WORDS, quality.OTHER: quality.ALL_WORDS}
    words = ", ".join(f"('{lang}', [{', '.join(repr(w) for w in found)}])" for lang, found in lists.items())
    languages = ", ".join(repr(lang) for lang in quality.COMMON_WORDS)
    space = r"\x20\x09-\x0D"

    def hits(pattern: str) -> str:
        return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"

    return rf"""
WITH lists(lang, list) AS (VALUES {words}),
texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
  CASE WHEN lang IN ({languages}) THEN lang ELSE '{quality.OTHER}' END AS lang FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^{space}]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{space}]')) AS lines FROM texts),
counted AS (SELECT *, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, {hits('[#*$%&|<>]')} AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM split),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w FROM (SELECT rid, ws, unnest(range(1, n_words - 1)) AS i FROM counted)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, range(0, 3) AS r(j) GROUP BY rid),
known AS (SELECT rid, lang, n_words, word_chars, [{hits('[A-Z]')}, {hits('[0-9]')}, length(t) - word_chars, n_symbols,
    {hits("[!" + chr(34) + "''()+,./:;=?@\\[\\]^_`{}~" + chr(92) * 2 + "-]")}, {hits("[^\\x00-\\x7F]")}] AS c, length(t) AS n_chars,
  list_transform(list, lambda x: len(list_filter(ws, lambda y: y = x))) AS f FROM counted JOIN lists USING (lang)),
bins AS (SELECT rid, lang, 'c' AS kind, unnest(list_append(c, n_chars - list_sum(c))) AS n, generate_subscripts(list_append(c, 0), 1) AS k FROM known
  UNION ALL SELECT rid, lang, 'w', unnest(list_append(f, n_words - list_sum(f))), generate_subscripts(list_append(f, 0), 1) FROM known),
sums AS (SELECT lang, kind, k, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang, kind) AS total FROM bins GROUP BY lang, kind, k),
shares AS (SELECT b.rid, b.kind, b.n / sum(b.n) OVER (PARTITION BY b.rid, b.kind) AS p, s.n / s.total AS q
  FROM bins b JOIN sums s USING (lang, kind, k) WHERE EXISTS (SELECT 1 FROM sums g WHERE g.lang = b.lang AND g.kind = 'w' AND g.total >= {quality.LEAST_REFERENCE_WORDS})),
apart AS (SELECT rid, kind, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 0)) AS d FROM shares GROUP BY rid, kind),
judged AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  n_words < {quality.LEAST_WORDS} OR 100 * coalesce(r.n, 0) > {quality.MOST_REPEATED} * n_words AS base_failed,
  word_chars >= {quality.LEAST_CHARS} AND (coalesce(c.d, 0) > {quality.MOST_CHAR_DISTANCE} OR coalesce(w.d, 0) > {quality.MOST_WORD_DISTANCE}) AS far
  FROM counted LEFT JOIN repeats r USING (rid) LEFT JOIN apart c ON c.rid = counted.rid AND c.kind = 'c'
  LEFT JOIN apart w ON w.rid = counted.rid AND w.kind = 'w')
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM judged
"""


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes that repeat 50 bytes or more of an earlier document."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near they and the next text's are."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines that repeat or resemble an earlier line."""
    return dedup_report(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash and the group it belongs to."""
    return near_groups(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation that no longer one goes on from, as one text."""
    return format_conversations(table(spark, sf_dir, "conversations"))


OP9_SQL = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS part
  FROM conversations WHERE conv_id IS NOT NULL),
prefixes AS (SELECT conv_id, pos, n, string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY pos) AS rendered FROM turns),
classes AS (SELECT rendered, n AS n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM prefixes WHERE pos = n GROUP BY ALL)
SELECT conv_id, n_turns, n_copies, rendered FROM classes
WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.pos < p.n AND p.pos = n_turns AND p.rendered = classes.rendered)
"""


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret and whether the forest takes it for one; the value itself only as a digest."""
    columns = ["doc_id", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), F.round("score", 9).alias("score"), "is_secret"]
    return scan(table(spark, sf_dir, "documents")).select(*columns)


#: No table has a list of blocked URLs: it is made of the pages on hosts named so.
LISTED_HOSTS = "casino|free-bets|ads-track|spam-farm|cheap-pills|adult"


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules and by a list of URLs."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return urls.judge_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def _op11_sql() -> str:
    def part(i: int) -> str:
        return f"regexp_extract(coalesce(url, ''), '{urls.PARTS}', {i})"

    def fits(host: str, path: str) -> str:
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

    rules = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h + p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in rules)
    return rf"""
WITH told AS (SELECT page_id, url, translate({part(1)}, '{urls.UPPER}', '{urls.LOWER}') AS host, {part(2)} AS path,
  list_sort(list_filter(string_split({part(3)}, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{urls.TRACKING}'))) AS asked FROM pages),
named AS (SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(regexp_replace(host, '{urls.NOT_IN_FRONT}', ''), '{urls.NOT_BEHIND}', '')
  || regexp_replace(path, '{urls.NOT_IN_PATH}', '') || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS canonical FROM told)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict}
  WHEN canonical <> '' AND canonical IN (SELECT canonical FROM named WHERE canonical IS NOT NULL AND regexp_matches(host, '{LISTED_HOSTS}')) THEN 'block'
  ELSE 'allow' END AS verdict FROM named
"""


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired by the cheapest edits."""
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with the form and the root it is a variant of."""
    return group_variants(run_counts(table(spark, sf_dir, "documents"), damage=True))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_repeats": op5_repeats,
    "op6_winnowing": op6_winnowing,
    "op7_lines": op7_lines,
    "op8_simhash": op8_simhash,
    "op9_chat": op9_chat,
    "op10_secrets": op10_secrets,
    "op11_urls": op11_urls,
    "op12_repair": op12_repair,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op4_quality": _op4_sql(),
    "op9_chat": OP9_SQL,
    "op11_urls": _op11_sql(),
}
