"""Domain names: canonical form, sharding and tags."""

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nameledger.functions.idna_udf import HAS_IDNA, idna_ascii, idna_ascii_array
from nameledger.functions.text import as_column, let, non_empty, once, trimmed

DEFAULT_SHARDS = 4

# Fixed patterns: the characters of a plain name; hyphens where a label may not have them (its
# ends, or third and fourth place); encoded labels; text outside ASCII.
_PLAIN = r"^[a-z0-9.-]*+$"
_BAD_HYPHEN = r"(?:^|\.)-|-(?:\.|$)|(?:^|\.)[^.]{2}--[^.]"
_ENCODED = r"(?:^|\.)xn--"
_NOT_ASCII = r"[^\x00-\x7f]"


def _idna_wanted(idna: bool) -> bool:
    if idna and not HAS_IDNA:
        warnings.warn("the idna package is missing: non-ASCII domains become null", stacklevel=3)
        return False
    return idna


def bare_domain(value: Column | str) -> Column:
    """Trimmed, lower-case, without trailing dots; null when nothing is left."""
    return non_empty(F.rtrim(F.lower(trimmed(value)), F.lit(".")))


def _is_plain(name: Column) -> Column:
    good_hyphens = ~name.contains("-") | ~(name.rlike(_BAD_HYPHEN) | name.rlike(_ENCODED))
    return name.rlike(_PLAIN) & good_hyphens


def _quick_name(value: Column | str) -> Column:
    """The bare name of text with nothing but spaces around it, which is nearly all text."""
    return F.rtrim(F.lower(F.trim(as_column(value))), F.lit("."))


def _judge(name: Column, text: Column) -> Column:
    none = F.lit(None).cast("string")

    def verdict(plain: Column, special: Column) -> Column:
        return F.struct(plain.alias("plain"), special.alias("special"))

    def thorough(bare: Column) -> Column:
        return F.when(
            bare.rlike(_NOT_ASCII) | bare.rlike(_ENCODED), verdict(none, bare)
        ).otherwise(verdict(F.when(_is_plain(bare), bare), none))

    # Only unusual text gets past the first branch, so the bare form may be worked out again there.
    return F.when(_is_plain(name), verdict(non_empty(name), none)).otherwise(
        thorough(bare_domain(text))
    )


def judge_domain(value: Column | str) -> Column:
    """STRUCT<plain, special>: the canonical name, or the bare name when only the UDF can tell."""
    text = as_column(value)
    return let(_quick_name(text), lambda name: _judge(name, text))


def normalize_domain(value: Column | str, idna: bool = True) -> Column:
    """Canonical ASCII domain, or null when the text is blank or not a valid name.

    Plain ASCII names are settled by built-in functions. Only the others reach the Arrow UDF;
    ``idna=False`` leaves the UDF out of the plan and maps those others to null. For a column of
    a large table ``with_domain`` does the same with less repeated work.
    """
    judged = judge_domain(value)
    if not _idna_wanted(idna):
        return judged["plain"]
    return F.coalesce(judged["plain"], idna_ascii(judged["special"]))


def with_domains(df: DataFrame, sources: dict[str, str], idna: bool = True) -> DataFrame:
    """Adds, for each name, the canonical form of the domain in its source column; one Python pass for all of them."""
    quick = once(df, "_quick", F.struct(*[_quick_name(source).alias(n) for n, source in sources.items()]))
    judged = once(quick, "_judged", F.struct(*[_judge(F.col(f"_quick.{n}"), F.col(source)).alias(n) for n, source in sources.items()]))
    found = {}
    for name in sources:
        found[name] = F.col(f"_judged.{name}.plain")
        if _idna_wanted(idna):
            found[name] = F.coalesce(found[name], idna_ascii(f"_judged.{name}.special"))
    named = once(judged, "_found", F.struct(*[value.alias(name) for name, value in found.items()]))
    return named.withColumns({name: F.col(f"_found.{name}") for name in sources}).drop("_quick", "_judged", "_found")


def with_domain(df: DataFrame, source: str, name: str, idna: bool = True) -> DataFrame:
    """Adds the canonical form of the domain in ``source`` as column ``name``."""
    return with_domains(df, {name: source}, idna)


def with_domain_arrays(df: DataFrame, arrays: dict[str, Column], idna: bool = True) -> DataFrame:
    """Adds, per entry, an array column with the canonical form of each element."""
    judged = F.struct(*[F.transform(a, judge_domain).alias(n) for n, a in arrays.items()])
    out = once(df, "_judged", judged)
    for name in arrays:
        items = F.col(f"_judged.{name}")
        plain = F.transform(items, lambda j: j["plain"])
        if _idna_wanted(idna):
            mixed = F.transform(items, lambda j: F.coalesce(j["plain"], j["special"]))
            special = F.exists(items, lambda j: j["special"].isNotNull())
            none = F.array().cast("array<string>")
            plain = F.coalesce(idna_ascii_array(F.when(special, mixed).otherwise(none)), plain)
        out = out.withColumn(name, plain)
    return out.drop("_judged")


def normalize_domain_lite(value: Column | str) -> Column:
    """Lenient query-side form: trim, lower-case, drop one trailing dot."""
    return F.regexp_replace(F.lower(trimmed(value)), r"\.$", "")


def domain_hash(value: Column | str) -> Column:
    """First four bytes of the SHA-256 of the name, as an unsigned big-endian number."""
    head = F.substring(F.sha2(as_column(value), 256), 1, 8)
    return F.conv(head, 16, 10).cast("bigint")


def shard_id(value: Column | str, n_shards: int = DEFAULT_SHARDS) -> Column:
    if n_shards <= 0:
        raise ValueError("n_shards must be positive")
    return F.pmod(domain_hash(value), F.lit(n_shards)).cast("int")


def domain_tags(domain: Column | str, base: Column | str | None = None) -> dict[str, Column]:
    """Boolean brand and CDN tags of a name; brands are looked for in ``base``."""
    name = as_column(domain)
    brand = name if base is None else as_column(base)
    return {
        "is_google": brand.contains("google"),
        "is_cdn": name.contains("cdn."),
        "is_social": brand.rlike("facebook|instagram|tiktok"),
        "is_facebook_related": brand.rlike("facebook|instagram"),
        "is_whatsapp_related": brand.contains("whatsapp"),
    }
