"""Quality rules for documents: counts of words, symbols and repeats, and divergence from a language's histograms.

All in built-in functions, row by row, with no shuffle of documents. The histograms of character classes and common
words are added up by language over all documents, and every document's two are compared with its language's by
Jensen-Shannon distance. The sums are one row per configured language and one for
all others, so what reaches the driver does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nameledger.functions.text import let, once
from nameledger.llm.common import words_of, written

# Frequent function words, by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "was", "for", "it", "with", "on", "as", "be", "by", "this", "are", "or", "an"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "ein", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "sur", "au", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
}
#: Languages without a list are held to one list of all these words.
OTHER = "other"
ALL_WORDS = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))

LEAST_WORDS = 50
MOST_REPEATED = 50
#: Shorter texts than this have no verdict from the histograms, nor has a language with less text than this.
LEAST_CHARS = 200
LEAST_REFERENCE_WORDS = 1_000
MOST_CHAR_DISTANCE = 0.25
MOST_WORD_DISTANCE = 0.3


def language_of(lang: Column) -> Column:
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(F.lit(OTHER))


def class_counts(text: Column, word_chars: Column) -> Column:
    """Code points by class: upper, digit, white space, symbol, other ASCII punctuation, beyond ASCII, all others."""

    def hits(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    known = [hits("[A-Z]"), hits("[0-9]"), F.length(text) - word_chars, hits(r"[#*$%&|<>]"), hits(r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]"), hits(r"[^\x00-\x7F]+")]
    return let(F.array(*known), lambda c: F.concat(c, F.array(F.length(text) - F.aggregate(c, F.lit(0), lambda a, x: a + x))))


def common_counts(words: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, then all other words together."""
    lists = F.create_map(*[x for k, v in {**COMMON_WORDS, OTHER: ALL_WORDS}.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    frequent = F.filter(words, lambda w: w.isin(*ALL_WORDS))
    counts = let(frequent, lambda f: F.transform(lists[lang], lambda w: F.size(f) - F.size(F.array_remove(f, w))))
    return let(counts, lambda c: F.concat(c, F.array(F.size(words) - F.aggregate(c, F.lit(0), lambda a, x: a + x))))


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text, the first one included.

    Windows are compared by 64-bit hash. The windows found once are a subsequence of all windows, so one walk
    along both tells which positions belong to repeated ones: linear in the text but for one sort of numbers.
    """
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), 1, F.greatest(F.size(words) - 2, F.lit(0))
    )

    def walk(all_of: Column, once_only: Column) -> Column:
        start = F.struct(*[F.lit(0).alias(n) for n in ("at", "next", "covered", "end")])

        def step(state: Column, window: Column) -> Column:
            single = F.get(once_only, state["next"]) == window
            ahead = state["at"] + 3
            return F.when(
                single,
                F.struct((state["at"] + 1).alias("at"), (state["next"] + 1).alias("next"), state["covered"].alias("covered"), state["end"].alias("end")),
            ).otherwise(
                F.struct(
                    (state["at"] + 1).alias("at"), state["next"].alias("next"),
                    (state["covered"] + ahead - F.greatest(state["end"], state["at"])).alias("covered"), ahead.alias("end"),
                )
            )

        return F.aggregate(all_of, start, lambda s, w: F.coalesce(step(s, w), s), lambda s: s["covered"])

    def counted(found: Column) -> Column:
        twice = let(F.sort_array(found), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1))))
        return let(twice, lambda t: F.when(F.size(t) == 0, F.lit(0)).otherwise(let(F.array_except(found, t), lambda u: walk(found, u))))

    return F.coalesce(let(windows, counted), F.lit(0))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of counts."""

    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def between(p: Column, q: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
        return F.sqrt(F.greatest(total(terms), F.lit(0.0)))

    def shares(c: Column) -> Column:
        return let(total(c), lambda n: F.transform(c, lambda x: x / n))

    return let(shares(counts), lambda p: let(shares(reference), lambda q: between(p, q)))


def with_words(docs: DataFrame) -> DataFrame:
    df = docs.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn("__lang", language_of(F.col("lang")))
    df = once(df, "__words", words_of(F.col("__text")))
    return once(df, "__word_chars", F.length(F.array_join("__words", "")))


def histograms() -> list[Column]:
    """The columns of a row's two histograms, over what ``with_words`` adds."""
    return [
        class_counts(F.col("__text"), F.col("__word_chars")).alias("classes"),
        common_counts(F.col("__words"), F.col("__lang")).alias("common"),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """Adds __lang and the struct __counts: the base counts and both histograms, worked out once per row."""
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = F.struct(
        F.size("__words").cast("bigint").alias("n_words"),
        F.col("__word_chars").cast("bigint").alias("word_chars"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("__words")).cast("bigint").alias("n_repeat_words"),
        *histograms(),
    )
    return once(with_words(docs), "__counts", counts).drop("__text", "__words", "__word_chars")


References = dict[str, tuple[list[int], list[int]]]


def references(counted: DataFrame) -> References:
    """Each language's summed histograms (of __lang, classes and common) over all rows: one row per configured
    language and one for all others."""
    sums = [F.sum(F.get("classes", F.lit(i)).cast("bigint")).alias(f"c{i}") for i in range(7)]
    sums += [F.sum(F.get("common", F.lit(i)).cast("bigint")).alias(f"w{i}") for i in range(len(ALL_WORDS) + 1)]
    found = {}
    for row in counted.groupBy("__lang").agg(*sums).collect():
        words = [row[f"w{i}"] for i in range(len(ALL_WORDS) + 1) if row[f"w{i}"] is not None]
        found[row["__lang"]] = ([row[f"c{i}"] for i in range(7)], words)
    return found


def verdict(measured: DataFrame, against: References) -> DataFrame:
    """Turns __lang and __counts into n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance and kept; a distance is null where a guard leaves it open."""
    known = {k: v for k, v in against.items() if sum(v[1]) >= LEAST_REFERENCE_WORDS}
    c = F.col("__counts")

    def by_language(at: int, counted: str) -> Column:
        value = F.lit(None).cast("double")
        for lang, sums in known.items():
            reference = F.array(*[F.lit(float(x)) for x in sums[at]])
            value = F.when(F.col("__lang") == lang, distance(c[counted], reference)).otherwise(value)
        return F.when((c["n_words"] >= LEAST_WORDS) & (c["word_chars"] >= LEAST_CHARS), value)

    failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
    distances = F.struct(by_language(0, "classes").alias("chars"), by_language(1, "common").alias("words"))
    d = F.col("__distances")
    far = (F.coalesce(d["chars"], F.lit(0.0)) > MOST_CHAR_DISTANCE) | (F.coalesce(d["words"], F.lit(0.0)) > MOST_WORD_DISTANCE)
    return once(measured, "__distances", distances).select(
        *[x for x in measured.columns if x not in ("__lang", "__counts")],
        c["n_words"].alias("n_words"),
        c["word_chars"].alias("word_chars"),
        F.get(c["classes"], F.lit(3)).cast("bigint").alias("n_symbols"),
        c["n_dup_lines"].alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"),
        failed.alias("base_failed"),
        d["chars"].alias("char_distance"),
        d["words"].alias("word_distance"),
        (~failed & ~far).alias("kept"),
    )


def judge(docs: DataFrame, against: References | None = None) -> DataFrame:
    """doc_id with the counts, distances and verdict of ``verdict``, one row per row of ``docs``.

    Reads doc_id, text and lang, other columns are passed over. Null texts have no words and fail; a null or unlisted
    language is held to all lists at once. Rows are judged one by one, also those with equal or null ids; only the
    languages' histograms look at all rows. The counts, some hundred bytes a row, go to the shared folder, so texts
    are read once. ``against`` gives other references than those of ``docs`` itself.
    """
    measured = measure(docs.select("doc_id", "text", "lang")).drop("text", "lang")
    if against is None:
        measured = written(measured, "quality")
        against = references(measured.select("__lang", "__counts.*"))
    return verdict(measured, against)


def keep_good(docs: DataFrame, against: References | None = None) -> DataFrame:
    """The documents the rules keep, with all their columns; a text is read again rather than stored again."""
    if against is None:
        against = references(with_words(docs.select("text", "lang")).select("__lang", *histograms()))
    packed = docs.select("text", "lang", F.struct("*").alias("__document"))
    decided = verdict(measure(packed).drop("text", "lang"), against)
    return once(decided, "__kept", F.col("kept")).where("__kept").select("__document.*")
