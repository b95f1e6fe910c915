"""URL filters: rules for hosts and paths first, then a list of blocked URLs.

A listed URL is compared in canonical form. A blocked Bloom filter of the list goes to every task: a URL belongs to one
block of 256 bits, in which eight bits are set. What the filter passes as possible hits, and only that, meets the list
itself in a hash join, so that no false positive is left. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import written

ALLOW, BLOCK = "allow", "block"

#: (verdict, host, path): a rule fits its host and all subdomains, where the URL's path starts with the rule's.
RULES = [(BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/")]

#: Bits a listed URL, in blocks of 256, and the most blocks the filter may have: with a key and four longs a block it
#: stays below 48 MB. A longer list makes the filter pass more to the join, which decides alone.
BITS_A_URL, BLOCK_BITS, MOST_BLOCKS = 16, 256, 1 << 20
WORDS, BITS_A_WORD = 4, 2
SALTS = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: What the canonical form leaves out: user info and www., default ports and a last dot, index pages and last slashes, tracking.
NOT_IN_FRONT = r"^(?:[^@]*@)?(?:www\.)?"
NOT_BEHIND = r"\.?(?::(?:80|443)?)?\z"
NOT_IN_PATH = r"(?:/index\.html?)?/*\z"
TRACKING = r"^(?:utm_[^=]*|gclid|fbclid|ref)="


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def canonical_url(url: Column) -> Column:
    """Host, path and query by which two spellings of a URL are the same; null where there is no ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), NOT_IN_FRONT, ""), NOT_BEHIND, "")
    path = F.regexp_replace(path_of(url), NOT_IN_PATH, "")
    asked = F.split(F.regexp_extract(url, PARTS, 3), "&")
    kept = F.array_join(F.array_sort(F.filter(asked, lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    whole = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(url.contains("://"), whole)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none does. Of rules of equal length the first counts."""
    rule = verdict = None
    for says, of, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule = F.when(fits, of + start) if rule is None else rule.when(fits, of + start)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if rule is None else (rule, verdict)


def _block(canonical: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), canonical), F.lit(blocks))


def _masks(canonical: Column) -> list[Column]:
    """The bits of a URL in each word of its block."""
    mixed = F.xxhash64(F.lit(2), canonical)
    out = []
    for word in range(WORDS):
        places = [F.shiftright(mixed, 6 * (BITS_A_WORD * word + i)).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_A_WORD)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]
        out.append(bits[0].bitwiseOR(bits[1]))
    return out


def blocked_bloom(listed: DataFrame) -> tuple[DataFrame, int]:
    """(block, w0..w3) of a column of different ``canonical`` URLs, and the number of blocks its size asks for."""
    blocks = 1
    needed = listed.count() * BITS_A_URL / BLOCK_BITS
    while blocks < min(needed, MOST_BLOCKS):
        blocks *= 2
    marked = listed.select(_block(F.col("canonical"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("canonical")))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds host, path, canonical, rule and verdict (allow or block) to every row with a ``url``.

    The longest rule that fits decides; where none does, a URL is blocked if its canonical form is that of a ``url`` of
    ``listed``. A null URL, or one without ``://``, has an empty host and path, no rule and no canonical form, and is
    allowed. Repeated rows stay rows of their own, an empty list blocks nothing, null or blank URLs in it list nothing,
    and a column of the pages named like one of the results is replaced by it.
    """
    results = ["host", "path", "canonical", "rule", "verdict"]
    names = {c: f"c{i}" for i, c in enumerate(pages.columns)}
    url = F.col(names["url"])
    told = pages.toDF(*names.values()).select("*", host_of(url).alias("host"), path_of(url).alias("path"), canonical_url(url).alias("canonical"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    told = told.select("*", rule.alias("rule"), verdict.alias("by_rule"))

    asked = listed.select(canonical_url(F.col("url")).alias("canonical")).where("canonical <> ''").distinct()
    known = written(asked, "listed-urls")
    bloom, blocks = blocked_bloom(known)
    open_url = F.when(F.col("rule").isNull(), F.col("canonical"))
    told = told.withColumn("block", _block(open_url, blocks))
    told = told.withColumn("block", F.when(F.col("rule").isNull() & F.col("canonical").isNotNull(), F.col("block")))
    told = told.join(F.broadcast(bloom), "block", "left")
    inside = F.lit(True)
    for i, mask in enumerate(_masks(F.col("canonical"))):
        inside = inside & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    possible = F.coalesce(inside, F.lit(False))

    clear = told.where(~possible).withColumn("verdict", F.coalesce("by_rule", F.lit(ALLOW)))
    hits = told.where(possible)
    sure = known.join(hits.select("canonical").distinct(), "canonical", "left_semi")
    # a URL that many rows have is spread: the join may not wait for one key
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    sure = sure.select("canonical", salts, F.lit(True).alias("sure"))
    hits = hits.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    hits = hits.join(sure, ["canonical", "salt"], "left").withColumn("verdict", F.when(F.col("sure"), BLOCK).otherwise(ALLOW))
    out = clear.unionByName(hits, allowMissingColumns=True)
    kept = [F.col(n).alias(c) for c, n in names.items() if c not in results]
    return out.select(*kept, *results)


def keep_allowed(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """The pages that rules and list allow, with their own columns (one named like a result is the result)."""
    return judge_urls(pages, listed, rules).where(F.col("verdict") == ALLOW).select(*pages.columns)
