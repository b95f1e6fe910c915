"""Secret scans: patterns propose candidates, a random forest takes out the false ones.

A candidate is a private key block, a web token of three parts, whatever is set to a name that sounds like a key, or a
run of key characters with letters and digits. What the forest sees of it: its length, its mix of and its changes between
character classes, how much of it dictionary words cover, whether it stands in a path, and the words beside it. The
forest is trained from labelled findings; built-in functions and Spark's own learner only.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nameledger.functions.text import let
from nameledger.llm.common import WHOLE_STAGE, most_frequent, setting, words_of, written

BEFORE, AFTER = 64, 24
MASK = "[SECRET]"
TREES, DEPTH, SEED = 20, 6, 11
#: Rows of each kind of labelled finding made for training, and the most frequent words kept as a dictionary.
EXAMPLES = 150
DICTIONARY = 2_000

KEY_WORDS = "token|secret|password|passwd|pwd|api.?key|access.?key|private.?key|auth(?!ors?\\b)|bearer|credential"
PLAIN_WORDS = "commit|revision|sha|md5|checksum|digest|hash|etag|build|version|uuid|guid|session.?id|order|page|image|href|src"

#: A name with a key word in it, and what sets it to a value; then the value, to its last character that ends no phrase.
LEAD = rf"(?i:{KEY_WORDS})[A-Za-z0-9_.\-]{{0,12}}[\"'`]?[ \t]{{0,4}}(?::=|=>|[=:])[ \t]{{0,4}}(?:(?i:bearer|basic)[ \t]{{1,4}})?[\"'`]?"
VALUE = r"[^\s\"'`]{5,}[^\s\"'`,;.)\]}]"
BLOCK = r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----[^\-]*(?:-(?!----)[^\-]*){0,40}-----END [A-Z ]{0,32}PRIVATE KEY-----"
WEB_TOKEN = r"(?<![A-Za-z0-9+/_\-])eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}"
RUN = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])(?=[0-9+/_\-]*[A-Za-z])[A-Za-z0-9+/_\-]{16,}={0,2}"
#: The lead belongs to the match, so that no lookbehind is needed, and is taken off it afterwards.
CANDIDATE = rf"{BLOCK}|{LEAD}(?:{BLOCK}|{VALUE})|{WEB_TOKEN}|{RUN}"
LED = rf"^({LEAD})(?:{BLOCK}|{VALUE})"

FEATURES = [
    "length", "digits", "uppers", "lowers", "symbols", "variety", "changes", "longest_letters", "covered", "is_hex", "slashes",
    "in_path", "assigned", "quoted", "key_word", "plain_word", "vowels", "marked", "code",
]


def dictionary(docs: DataFrame) -> list[str]:
    """The most frequent words of three letters or more of all texts, in lower case: a list of bounded length."""
    words = docs.select(F.explode(words_of(F.col("text"))).alias("word")).where("length(word) >= 3")
    bare = words.select(F.lower(F.regexp_replace("word", r"[^\p{L}]", "")).alias("word"))
    return sorted(word for word, _ in most_frequent(bare.where("length(word) >= 3"), DICTIONARY))


def with_features(findings: DataFrame, known: list[str]) -> DataFrame:
    """Adds ``FEATURES`` to rows with value, before and after."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)

    classes = value
    for pattern, letter in (("[a-z]", "a"), ("[A-Z]", "B"), ("[0-9]", "0"), (r"[^aB0]", "-")):
        classes = F.regexp_replace(classes, pattern, letter)
    # capitals first become B, and no other class is written with a character of a class replaced after it
    runs = F.regexp_extract_all(value, F.lit("[A-Za-z]+"), 0)
    words = F.filter(F.transform(runs, F.lower), lambda w: w.isin(*known) if known else F.lit(False))
    made = {
        "length": F.length(value),
        "digits": share("[^0-9]"),
        "uppers": share("[^A-Z]"),
        "lowers": share("[^a-z]"),
        "symbols": share("[A-Za-z0-9]"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / F.least(F.length(value), F.lit(64)),
        "changes": F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / F.length(value),
        "longest_letters": F.array_max(F.transform(runs, F.length)),
        "covered": F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)) / F.length(value),
        "is_hex": value.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "slashes": F.length(value) - F.length(F.replace(value, F.lit("/"), F.lit(""))),
        "in_path": before.rlike(r"(?:://[^\s]*|[/.?&][A-Za-z0-9_%=.\-]*|\\)$") | after.rlike(r"^(?:/|\.[a-z]{2,4}\b)"),
        "assigned": before.rlike(r"(?:[=:]|=>)\s*[\"'`]?$|(?i:bearer|basic)\s+[\"'`]?$"),
        "quoted": before.rlike(r"[\"'`]$") & after.rlike(r"^[\"'`]"),
        "key_word": before.rlike(rf"(?i)(?:{KEY_WORDS})[^\n]{{0,24}}$"),
        "plain_word": before.rlike(rf"(?i)(?:{PLAIN_WORDS})[^\n]{{0,12}}$"),
        "vowels": share("[^AEIOUaeiou]"),
        "marked": value.rlike("^(?:-----BEGIN|eyJ|AKIA|ghp_|sk-|xoxb-|glpat-)"),
        "code": value.rlike(r"^[$<{*]|[(\[]|://|^[A-Za-z_]+(?:\.[A-Za-z_]+)+"),
    }
    return findings.withColumns({name: F.coalesce(made[name].cast("double"), F.lit(0.0)) for name in FEATURES})


def labelled_findings(spark: SparkSession, known: list[str], examples: int = EXAMPLES, salt: str = "a") -> DataFrame:
    """value, before, after and label: ``examples`` findings of each kind, keys and look-alikes, in varied surroundings.

    The words around them come from the dictionary; everything follows from row numbers and ``salt``.
    """
    listed = F.split(F.lit(" ".join(known[:500] or ["word"])), " ")  # one constant in the plan, not one a word
    word = lambda n: F.get(listed, F.pmod(F.hash("id", F.lit(salt), F.lit(n)), F.size(listed)))
    pick = lambda n, *options: F.get(F.array(*map(F.lit, options)), F.pmod(F.hash("id", F.lit(salt), F.lit(n)), F.lit(len(options))))
    sha = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 512)
    hexes = F.substring(sha, F.lit(1), pick(1, 32, 40, 48, 64))
    coded = F.substring(F.regexp_replace(F.base64(F.unhex(sha)), "=", ""), F.lit(1), pick(2, 20, 24, 32, 40, 64))
    either = F.when(F.pmod(F.hash("id", F.lit("case")), F.lit(4)) == 0, F.upper(hexes)).otherwise(hexes)
    number = F.pmod(F.hash("id", F.lit(salt)), F.lit(90_000)).cast("string")
    joined = lambda mark: F.concat_ws(mark, word(3), word(4), word(5), number)
    dashed = F.regexp_replace(F.substring(sha, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    key = pick(6, "token", "TOKEN", "secret", "api_key", "apiKey", "password", "access_key", "auth_token", "client_secret")
    set_to = pick(7, ' = "', '="', ": ", '": "', " = '", "=", " := \"")
    prose = F.concat(word(8), F.lit(" "), word(9), F.lit(" "))
    # letters only, passwords of a word, digits and marks, and what else may stand after a key word
    letters = F.call_function(
        "translate", F.substring(sha, F.lit(1), pick(23, 16, 20, 24, 30, 40)), F.lit("0123456789"), pick(24, "ghijklmnop", "qrstuvwxyz", "kmpqrtvwxz")
    )
    cased = F.when(F.pmod(F.hash("id", F.lit("cased")), F.lit(3)) == 0, F.upper(letters)).otherwise(letters)
    mark = lambda n: pick(n, "!", "@", "#", "&", "%", "?", "+", "*")
    stem = F.when(F.pmod(F.hash("id", F.lit("stem")), F.lit(2)) == 0, F.initcap(F.left(word(25), F.lit(7)))).otherwise(F.left(word(25), F.lit(7)))
    phrase = F.concat(stem, F.right(number, F.lit(3)), mark(26), F.left(coded, pick(27, 1, 2, 3, 5)), pick(28, "", "!", "!!", "9", "#1"))
    chosen = F.concat(F.left(coded, pick(29, 4, 6, 8)), mark(30), F.substring(sha, F.lit(9), pick(31, 2, 4, 6)), mark(32), F.right(number, F.lit(2)))
    name = pick(33, "password", "DB_PASSWORD", "passwd", "pwd", "secret_key", "API_KEY", "client_secret", "MYSQL_PASSWORD", "token", "auth_token")
    web = F.concat(F.lit("eyJ"), F.left(coded, F.lit(17)), F.lit(".eyJ"), coded, F.lit("."), F.left(F.translate(F.base64(F.unhex(sha)), "+/=", "-_"), F.lit(43)))
    kind = pick(34, "RSA ", "", "EC ", "OPENSSH ")
    block = F.concat(F.lit("-----BEGIN "), kind, F.lit("PRIVATE KEY-----\n"), coded, F.lit("\n"), coded, F.lit("\n-----END "), kind, F.lit("PRIVATE KEY-----"))
    strange = F.concat(F.left(word(35), F.lit(5)), F.right(word(36), F.lit(5)))  # reads like a word, but is none
    called = F.concat(word(37), F.lit("."), word(38), pick(39, "(", "[", ".", "_"), word(40), pick(41, "(", ".x", "_id", "["))
    held_place = F.concat(pick(42, "<your-", "${", "{{", "<"), word(43), pick(44, "-here>", "_key}", "}}", ">"))
    closing = pick(46, '" ', "' ", '"', "\n", " ")
    kinds = [
        (1, either, F.concat(prose, key, set_to), pick(10, '" ', "' ", '"', "\n")),
        (1, coded, F.concat(prose, key, set_to), pick(10, '" ', "' ", '"', "\n")),
        (1, F.concat(pick(11, "AKIA", "ghp_", "sk-", "xoxb-", "glpat-"), coded), F.concat(prose, pick(12, "", "key ", "use ", '"')), F.lit(" ")),
        (1, coded, F.concat(prose, F.lit("Authorization: Bearer ")), F.lit("\n")),
        (0, either, F.concat(prose, pick(13, "commit ", "sha1: ", "md5 = ", "checksum: ", "digest ", "ETag: ", "build ")), pick(14, " ", ".", ")")),
        (0, hexes, F.concat(prose, F.lit("https://"), word(15), F.lit(".example.com/"), word(16), F.lit("/")), pick(17, ".html", ".png", "/", " ")),
        (0, joined("-"), prose, F.concat(F.lit(" "), word(18))),
        (0, joined("_"), F.concat(prose, pick(19, "page = ", "href=\"/", "", "image: ", "see ")), F.lit(" ")),
        (0, F.concat(F.lit("/"), joined("/")), F.concat(prose, F.lit("in ")), pick(20, ".html", "/", " ")),
        (0, dashed, F.concat(prose, pick(21, "uuid ", "id: ", "session id = ", "guid=")), F.lit(" ")),
        (0, F.concat(word(22), word(23), word(24), number), prose, F.lit(". ")),
        (1, cased, F.concat(prose, name, set_to), closing),
        (1, phrase, F.concat(prose, name, set_to), closing),
        (1, chosen, F.concat(prose, name, set_to), closing),
        (1, web, F.concat(prose, pick(45, "", "Bearer ", 'jwt: "', "token=")), closing),
        (1, block, F.concat(prose, pick(47, "", "\n", 'private_key: "')), closing),
        (0, pick(48, "required", "optional", "changed", "missing", "expired", "invalid", "example"), F.concat(prose, name, set_to), closing),
        (0, F.when(F.length(strange) > 5, strange).otherwise(F.concat(strange, strange)), F.concat(prose, name, set_to), closing),
        (0, F.concat(word(49), pick(50, "-", "_", "/"), word(51)), F.concat(prose, name, set_to), closing),
        (0, F.concat(F.lit("https://"), word(52), F.lit(".example.com/"), word(53)), F.concat(prose, name, set_to), closing),
        (0, called, F.concat(prose, name, pick(54, " = ", "=", ": ")), pick(55, ") ", '"', "\n", ")")),
        (0, held_place, F.concat(prose, name, set_to), closing),
        (0, F.repeat(pick(56, "*", "x", "X", "."), pick(57, 6, 8, 12, 20)), F.concat(prose, name, set_to), closing),
    ]
    rows = [
        F.struct(value.alias("value"), F.right(before, F.lit(BEFORE)).alias("before"), F.left(after, F.lit(AFTER)).alias("after"), F.lit(float(label)).alias("label"))
        for label, value, before, after in kinds
    ]
    return spark.range(examples).select(F.inline(F.array(*rows)))


def train(labelled: DataFrame, known: list[str]) -> PipelineModel:
    """A forest over ``FEATURES`` from labelled findings: value, before, after and label (1.0 for a secret).

    The labelled rows are a sample whose size the caller bounds, so they are put in one order in one task. They are
    written once, without code generated for the few of them: the learner plans and reads its rows again and again, and
    the code of all kinds of made findings is more than one generated method can hold.
    """
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    rows = with_features(labelled.where("value IS NOT NULL AND label IS NOT NULL"), known)
    rows = rows.coalesce(1).sortWithinPartitions("value", "before").select("label", *FEATURES)
    with setting(labelled.sparkSession, WHOLE_STAGE, "false"):
        rows = written(rows, "labelled-findings")
    rows = assembler.transform(rows.coalesce(1))
    return PipelineModel([assembler, forest.fit(rows.select("features", "label"))])


def candidates(rows: DataFrame, text: Column, *keep: str | Column) -> DataFrame:
    """``keep``, __found and __parts, worked out once a row: text = p0 lead0 value0 p1 lead1 value1 ... pn."""
    matches, parts = F.regexp_extract_all(text, F.lit(CANDIDATE), 0), F.split(text, CANDIDATE, -1)
    split = rows.select(*keep, F.explode(F.array(F.struct(matches.alias("matches"), parts.alias("parts")))).alias("__split"))

    def cut(match: Column) -> Column:
        lead = F.regexp_extract(match, LED, 1)
        return let(lead, lambda x: F.struct(x.alias("lead"), F.substr(match, F.length(x) + 1).alias("value")))

    names = [c for c in split.columns if c != "__split"]
    found = F.transform("__split.matches", cut)
    return split.select(*names, F.explode(F.array(found)).alias("__found"), F.col("__split.parts").alias("__parts"))


def exploded(rows: DataFrame) -> DataFrame:
    """One row per candidate of rows with __found and __parts: at, skipped (characters since the last), value, before and after."""

    def finding(x: Column, at: Column) -> Column:
        before = F.concat(F.get("__parts", at), x["lead"])
        after = F.left(F.get("__parts", at + 1), F.lit(AFTER))
        return F.struct(F.length(before).alias("skipped"), x["value"].alias("value"), F.right(before, F.lit(BEFORE)).alias("before"), after.alias("after"))

    names = [c for c in rows.columns if c not in ("__found", "__parts")]
    return rows.select(*names, F.posexplode(F.transform("__found", finding)).alias("at", "__finding")).select(*names, "at", "__finding.*")


def judged(found: DataFrame, model: PipelineModel, known: list[str]) -> DataFrame:
    """Adds score, the forest's share of votes for a secret, and is_secret; the features and vectors go."""
    scored = model.transform(with_features(found, known))
    score = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*found.columns, score.alias("score"), (F.col("prediction") == 1.0).alias("is_secret"))


def learned(docs: DataFrame) -> tuple[PipelineModel, list[str]]:
    known = dictionary(docs)
    return train(labelled_findings(docs.sparkSession, known), known), known


def scan(docs: DataFrame, model: PipelineModel | None = None, known: list[str] | None = None) -> DataFrame:
    """doc_id, at, start, value, before, after, score and is_secret: one row per candidate.

    Reads doc_id and text, other columns are passed over. Null and empty texts have no candidates; rows with equal or
    null ids are scanned each for itself; every occurrence is a candidate of its own. Whole texts are searched; only
    findings are shuffled, to add up their places. With no ``model``, one is trained from labelled findings made with
    the words of these documents.
    """
    if model is None:
        model, known = learned(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").rlike(CANDIDATE))
    found = exploded(candidates(rows.withColumn("__row", F.monotonically_increasing_id()), F.col("text"), "__row", "doc_id"))
    in_text = Window.partitionBy("__row").orderBy("at")
    start = F.sum(F.col("skipped") + F.length("value")).over(in_text) - F.length("value")
    out = found.select("doc_id", "at", start.cast("int").alias("start"), "value", "before", "after")
    return judged(out, model, known or [])


def mask_secrets(docs: DataFrame, model: PipelineModel | None = None, known: list[str] | None = None) -> DataFrame:
    """The documents with every secret replaced by ``MASK``; all columns and all other texts stay as they are.

    Documents without a candidate are passed through unmoved; of the others, only numbers and verdicts are joined.
    """
    if model is None:
        model, known = learned(docs)
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    hits = docs.where(has).select(F.struct(*[docs[c] for c in docs.columns]).alias("__document"))
    hits = candidates(hits, F.col("__document.text"), "__document")
    hits = written(hits.withColumn("__row", F.monotonically_increasing_id()), "secret-candidates")
    verdicts = judged(exploded(hits.select("__row", "__found", "__parts")), model, known or [])
    in_order = F.array_sort(F.collect_list(F.struct("at", "is_secret")))
    secret = verdicts.groupBy("__row").agg(in_order.alias("__verdicts"), F.max("is_secret").alias("__any")).where("__any")
    secret = secret.select("__row", F.col("__verdicts.is_secret").alias("__secret"))

    def rebuilt(at: Column) -> Column:
        pieces = F.transform(
            F.arrays_zip("__parts", "__found"),
            lambda x, i: F.concat(
                x["__parts"],
                F.coalesce(x["__found"]["lead"], F.lit("")),
                F.when(F.get(at, i), F.lit(MASK)).otherwise(F.coalesce(x["__found"]["value"], F.lit(""))),
            ),
        )
        return F.array_join(pieces, "")

    joined = hits.join(secret, "__row", "left")
    text = F.when(F.col("__secret").isNull(), F.col("__document.text")).otherwise(let(F.col("__secret"), rebuilt))
    masked = joined.select(*[text.alias(c) if c == "text" else F.col("__document")[c].alias(c) for c in docs.columns])
    return docs.where(~has).unionByName(masked)
