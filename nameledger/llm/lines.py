"""Line dedup by an exact set-similarity self-join, in built-in functions.

A line is the set of its words. Equal lines are one class, found by grouping. Words are ordered by rarity, by counts over
the words of all classes, and two sets with a Jaccard similarity of 0.8 share a word among the rarest few of each (prefix
filter), so those words are the join's keys. Where such a word is frequent, it is a key only together with a second word
of a prefix longer by one, which two similar sets share as well. Lengths and the places of the shared word rule out most
pairs before words are compared.

A key of few classes gives its pairs where they are grouped. Families of many similar classes are not expanded into all
pairs: every class first meets the earliest class of such a key, and only those that found no earlier match there meet
the others. Two parities of the words, joined to pairs only, spare most pairs the comparison of whole sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nameledger.functions.text import let
from nameledger.llm.common import Scratch, written

#: Sets of fewer words are similar by 0.8 only if they are equal; four words and a fifth are similar.
LEAST_WORDS = 4
#: A similarity of 0.8 in whole numbers: WHOLE * shared >= PART * united.
PART, WHOLE = 4, 5
#: Counts of words are kept in slots by hash, two bits each, one for so many words: the order is only for speed.
WORDS_OF_SLOT, LEAST_SLOTS, MOST_SLOTS, CHUNK = 16, 1 << 14, 1 << 24, 1 << 12
#: A rank is four times the binary logarithm of the count of eight slots; from FREQUENT on a word alone is no key.
#: A slot counted once (ONCE) holds one word of one set: no other set has it, so it is no key either.
LEVELS, FREQUENT, ONCE = 126, 40, 5
RANK_BIT = 56
#: A file of sets names its words by a dictionary of up to so many bytes: frequent words take some bits, not eight bytes.
DICTIONARY_BYTES = 16 << 20
#: Classes of a key that are paired in the task that groups them; in larger groups the earliest class comes first.
FEW = 32

SEPARATORS, SPACES = "\t\x0b\x0c\r", "    "


def words_in(line: Column) -> Column:
    """The words of one line, separated by spaces, tabs, vertical tabs, form feeds and carriage returns."""
    return F.array_remove(F.split(F.translate(line, SEPARATORS, SPACES), " "), "")


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no and line of every line; rows with equal id and text are the same lines."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("lines"))
    return lines.select("doc_id", "text_hash", F.posexplode("lines").alias("line_no", "line"))


def _place() -> Column:
    return F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "text_hash", "line_no")


def _name() -> list[Column]:
    return [F.xxhash64(F.lit(salt), "line").alias(c) for salt, c in ((1, "one"), (2, "two"))]


def with_words(lines: DataFrame) -> DataFrame:
    """The line's distinct words as sorted 64-bit hashes (tokens) and their number n."""
    tokens = F.sort_array(F.array_distinct(F.transform(words_in(F.col("line")), lambda w: F.xxhash64(w))))
    found = lines.select("*", F.explode(F.array(tokens)).alias("tokens"))
    return found.select("*", F.size("tokens").alias("n"))


def slots_for(words: int) -> int:
    """As many slots as keep the chance meetings of rare words few: a power of two."""
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (words // WORDS_OF_SLOT).bit_length()))


def _eighth(word: Column, slots: int) -> Column:
    """Which eight slots a word's is one of, by the top of its hash; the last three bits say which of the eight."""
    return F.shiftrightunsigned(word, 67 - (slots - 1).bit_length())


def rank_table(sets: DataFrame, slots: int) -> DataFrame:
    """One row, ranks: how frequent the words are that hash to a slot, counted over all sets.

    Sixteen bits for each eight slots: a bit for each slot counted more than once, above them the rank of these slots
    together. The value goes through the driver and with tasks, so it has to be small.
    """
    spark = sets.sparkSession
    word = F.col("word")
    slot = F.shiftleft(_eighth(word, slots), 3).bitwiseOR(word.bitwiseAND(F.lit(7))).alias("slot")
    counted = sets.select(F.explode("tokens").alias("word")).select(slot, F.lit(1).cast("bigint").alias("n"))
    every = counted.unionByName(spark.range(0, slots, 8).select(F.col("id").alias("slot"), F.lit(0).cast("bigint").alias("n")))
    by_slot = every.groupBy("slot").agg(F.sum("n").alias("n")).withColumn("n", F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    bit = F.call_function("shiftleft", F.lit(1), F.col("slot").bitwiseAND(F.lit(7)).cast("int"))
    level = F.least(F.lit(LEVELS), F.floor(4 * F.log2(F.sum("n") + 1))) + 1
    held = F.sum(F.when(F.col("n") > 0, bit).otherwise(0)) + 256 * level
    numbers = by_slot.groupBy(F.shiftright("slot", 3).alias("at")).agg(F.array(held.cast("smallint")).alias("ranks"))

    def joined(parts: DataFrame, by: list[Column]) -> DataFrame:
        in_order = F.array_sort(F.collect_list(F.struct("at", "ranks")))
        return parts.groupBy(*by).agg(F.flatten(F.transform(in_order, lambda s: s["ranks"])).alias("ranks"))

    chunks = joined(numbers, [F.floor(F.col("at") / CHUNK).alias("chunk")]).withColumnRenamed("chunk", "at")
    return joined(chunks, []).select("ranks")


def by_rarity(tokens: Column, ranks: Column, slots: int) -> Column:
    """The words as numbers, the rarest first: the rank stands above the word's hash."""

    def ranked(word: Column, held: Column) -> Column:
        repeated = F.call_function("shiftright", held, word.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
        rank = F.when(repeated, F.shiftright(held, 8)).otherwise(F.lit(ONCE))
        return F.shiftleft(rank.cast("bigint"), RANK_BIT).bitwiseOR(F.shiftrightunsigned(word, 64 - RANK_BIT))

    held = F.transform(tokens, lambda word: F.get(ranks, _eighth(word, slots)).cast("int"))
    return F.sort_array(F.zip_with(tokens, held, ranked))


def prefix_keys(words: Column, n: Column) -> Column:
    """(key, at): the words of the prefix, frequent ones joined with each later word of the prefix longer by one."""
    prefix = n - F.ceil(n * PART / WHOLE).cast("int") + 1

    def keys(word: Column, at: Column) -> Column:
        alone = F.array(F.struct(word.alias("key"), at.alias("at")))
        pairs = F.transform(F.slice(words, at + 2, prefix - at), lambda other: F.struct(F.xxhash64(word, other).alias("key"), at.alias("at")))
        return F.when(word < F.lit(FREQUENT << RANK_BIT), alone).otherwise(pairs)

    # the places stay those in the whole order: only the keys of words without a second set are left out
    single = F.size(F.filter(F.slice(words, 1, prefix), lambda word: word < F.lit((ONCE + 1) << RANK_BIT)))
    return let(single, lambda skip: F.flatten(F.transform(F.slice(words, skip + 1, prefix - skip), lambda word, i: keys(word, i + skip))))


def parity(tokens: Column, shift: int) -> Column:
    """64 bits, each the parity of the words that hash to it: sets differ in at least as many words as bits."""
    one = F.lit(1).cast("bigint")
    place = lambda x: F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(63)).cast("int")
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", one, place(x))))


def needed(a_n: Column, b_n: Column) -> Column:
    """How many words sets of these sizes have to share."""
    return F.ceil((a_n + b_n) * PART / (PART + WHOLE))


def mark_of(n: Column, at: Column) -> Column:
    """Length and place of a key's word in one number, to be sent with each key."""
    return F.shiftleft(n.cast("bigint"), 32).bitwiseOR(at.cast("bigint"))


def possible(a: Column, b: Column) -> Column:
    """False only for pairs (mark, odd) that cannot reach the similarity: by length, place in the prefix and parities."""
    (a_n, a_at), (b_n, b_at) = ((F.shiftrightunsigned(x["mark"], 32), x["mark"].bitwiseAND(F.lit((1 << 32) - 1))) for x in (a, b))
    least = needed(a_n, b_n)
    lengths = (a_n * WHOLE >= b_n * PART) & (b_n * WHOLE >= a_n * PART)
    reachable = F.least(a_n - a_at, b_n - b_at) >= least  # if the key's word is the first they share
    return lengths & reachable & (F.bit_count(a["odd"].bitwiseXOR(b["odd"])) <= a_n + b_n - 2 * least)


def matched(pairs: DataFrame, sets: DataFrame, scratch: Scratch, what: str) -> DataFrame:
    """The classes a of ``pairs`` (a, b) whose b is earlier and similar."""
    wanted = sets.where(F.col("n") >= LEAST_WORDS)

    def marks(of: str) -> DataFrame:
        return wanted.select(F.col("id").alias(of), *[F.col(c).alias(f"{of}_{c}") for c in ("n", "even", "first")])

    near = pairs.join(marks("b"), "b").join(marks("a"), "a").where("b_first < a_first")
    apart = F.bit_count(F.col("a_even").bitwiseXOR(F.col("b_even")))
    near = near.where(apart <= F.col("a_n") + F.col("b_n") - 2 * needed(F.col("a_n"), F.col("b_n"))).select("a", "b")
    near = scratch.keep(near, what)
    few = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    held = scratch.keep(wanted.join(few, "id", "left_semi").select("id", "tokens"), f"{what}-sets")
    left, right = (held.select(F.col("id").alias(of), F.col("tokens").alias(f"{of}_tokens")) for of in ("a", "b"))
    both = near.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    similar = shared * (PART + WHOLE) >= (F.size("a_tokens") + F.size("b_tokens")) * PART
    return both.where(similar).select("a").distinct()


def later_matches(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """The ids of the classes that have an earlier similar one."""
    # below four words, only equal sets are similar
    same = Window.partitionBy("n", F.xxhash64(F.lit(1), "tokens"), F.xxhash64(F.lit(2), "tokens"))
    short = sets.where((F.col("n") > 0) & (F.col("n") < LEAST_WORDS)).select("id", "first", F.min("first").over(same).alias("least"))
    equal = short.where("first > least").select(F.col("id").alias("a"))

    words = sets.where(F.col("n") >= LEAST_WORDS).select("id", "n", F.col("first.doc").alias("doc"), "odd", "tokens")
    slots = slots_for(words.agg(F.sum("n")).first()[0] or 0)
    # the table of ranks is a subquery's value: as a literal it would be spelled out in every description of the plan
    ranks = scratch.keep(rank_table(words, slots), "ranks")
    ranked = words.withColumn("ranks", ranks.scalar())
    ordered = let(by_rarity(F.col("tokens"), F.col("ranks"), slots), lambda found: prefix_keys(found, F.col("n")))
    keyed = ranked.select("id", "n", "doc", "odd", ordered.alias("keys")).select("id", "n", "doc", "odd", F.inline("keys"))
    keyed = keyed.select("key", "id", "doc", mark_of(F.col("n"), F.col("at")).alias("mark"), "odd")

    # one exchange by key: the only class of a key goes, few classes give pairs, each of many gives itself
    by_key = Window.partitionBy("key")
    lead = F.min(F.struct("doc", "id", "mark", "odd")).over(by_key)
    sized = keyed.select("*", lead.alias("lead"), F.count("*").over(by_key).alias("size")).where("size > 1")
    alone = F.when(F.col("size") > FEW, F.col("id")).otherwise(-1)
    grouped = sized.groupBy("key", alone.alias("alone")).agg(F.collect_list(F.struct("doc", "id", "mark", "odd", "lead")).alias("held"))

    def partners(m: Column) -> Column:
        fit = F.filter("held", lambda o: (o["doc"] <= m["doc"]) & (o["id"] != m["id"]) & possible(m, o))
        return F.transform(fit, lambda o: F.struct(m["id"].alias("a"), o["id"].alias("b")))

    pairs = F.when(F.col("alone") < 0, F.flatten(F.transform("held", partners)))
    member = F.when(F.col("alone") >= 0, F.get("held", F.lit(0)))
    found = grouped.select(F.when(member.isNotNull(), F.col("key")).alias("key"), pairs.alias("pairs"), member.alias("m"))
    found = scratch.keep(found.where((F.size("pairs") > 0) | F.col("m").isNotNull()), "found")
    members = found.where("m IS NOT NULL").select("key", "m.*")
    led = (F.col("id") != F.col("lead.id")) & possible(F.struct("mark", "odd"), F.col("lead"))
    star = members.where(led).select(F.col("id").alias("a"), F.col("lead.id").alias("b"))
    star = scratch.keep(star.unionByName(found.select(F.inline("pairs"))).distinct(), "star")
    settled = scratch.keep(matched(star, sets, scratch, "near"), "settled")
    # those that no leader settled meet all others; a pair with the leader is known already
    open_ones = members.join(settled, members["id"] == settled["a"], "left_anti")
    earlier = (F.col("m.id") != F.col("o.id")) & (F.col("o.doc") <= F.col("m.doc")) & (F.col("o.id") != F.col("m.lead.id"))
    rest = open_ones.alias("m").join(members.drop("lead").alias("o"), F.col("m.key") == F.col("o.key"))
    sides = [{c: F.col(f"{side}.{c}") for c in ("mark", "odd")} for side in ("m", "o")]
    rest = rest.where(earlier & possible(*sides))
    rest = rest.select(F.col("m.id").alias("a"), F.col("o.id").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    late = matched(rest, sets, scratch, "rest")
    return settled.unionByName(late).unionByName(equal)


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and removed_lines (numbers from 0) of every text that loses a line.

    A line is removed if an earlier one, in the order of doc_id, text and place, is similar by
    0.8 or more or has the same words. Blank lines are left alone. Null texts are one empty line;
    null ids come last; rows with equal id and text count once, as the same lines.
    """
    lines = split_lines(docs)
    with Scratch(docs.sparkSession, "lines", {"sets": DICTIONARY_BYTES}) as scratch:
        grouped = lines.select(*_name(), _place().alias("place"), "line").groupBy("one", "two")
        classes = grouped.agg(F.min("place").alias("first"), F.first("line").alias("line"))
        marks = [parity(F.col("tokens"), shift).alias(c) for shift, c in ((0, "odd"), (6, "even"))]
        found = with_words(classes).where("n > 0").select("one", "two", "first", "n", "tokens", *marks)
        sets = found.withColumn("id", F.monotonically_increasing_id())
        sets = scratch.keep(sets, "sets")
        late = scratch.keep(later_matches(sets, scratch), "late")
        for what in ("ranks", "found", "star", "settled", "near", "near-sets", "rest", "rest-sets"):
            scratch.drop(what)
        gone = late.select(F.col("a").alias("id"), F.lit(True).alias("gone")).distinct()
        named = sets.select("one", "two", "first", "id").join(gone, "id", "left").drop("id")
        decided = lines.select("doc_id", "text_hash", "line_no", _place().alias("place"), *_name()).join(named, ["one", "two"])
        decided = decided.where(F.coalesce("gone", F.lit(False)) | (F.col("place") > F.col("first")))
        by_text = decided.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line_no")).alias("removed_lines"))
        return written(by_text, "removed-lines")


def dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_lines, n_removed and removed_lines (numbers from 0): one row per different (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    n_lines = F.size(F.split(text, "\n")).cast("bigint")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), n_lines.alias("n_lines"))
    texts = texts.groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"))
    gone = removed_lines(docs).withColumnsRenamed({"doc_id": "doc", "text_hash": "hash"})
    joined = texts.join(gone, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("text_hash") == F.col("hash")), "left")
    found = F.coalesce("removed_lines", F.array().cast("array<int>"))
    return joined.select("doc_id", "text_hash", "n_lines", F.size(found).cast("bigint").alias("n_removed"), found.alias("removed_lines"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents without removed lines, all their columns kept; a text that loses all of them becomes empty."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"), F.struct("*").alias("row")
    )
    joined = rows.join(removed_lines(docs), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("text_hash")), "left")
    held, text = F.col("removed_lines"), F.col("row.text")

    def without(gone: Column) -> Column:
        marked = F.transform(F.split(text, "\n"), lambda line, i: F.when(F.array_contains(gone, i), F.lit(None)).otherwise(line))
        return F.array_join(marked, "\n")

    kept = F.when(held.isNull(), text).otherwise(let(held, without))
    return joined.select(*[kept.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
