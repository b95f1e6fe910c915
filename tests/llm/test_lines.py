import math
import random

from nameledger.llm import lines
from nameledger.llm.lines import dedup_report, drop_repeated_lines

SCHEMA = "doc_id bigint, text string, n int, one string, row int, own string"


def removed_lines(data):
    """By comparing all lines with all earlier ones."""
    order = sorted({(d if d is not None else 1 << 63, t or "", d) for d, t in data}, key=lambda x: (x[0], x[1]))
    seen, out = [], {}
    for _, text, doc in order:
        gone = []
        for at, line in enumerate(text.split("\n")):
            words = frozenset(line.split())
            if len(words) < 5:
                continue
            if any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                gone.append(at)
            seen.append(words)
        out[doc, text] = gone
    return out


def corpus(seed):
    draw = random.Random(seed)
    rare = [f"rare{i}" for i in range(400)]
    common = [f"c{i}" for i in range(8)]
    base = [draw.sample(rare, draw.randint(3, 30)) + draw.choices(common, k=draw.randint(0, 9)) for _ in range(25)]
    base += [draw.sample(common, k) for k in (5, 6, 7, 8) for _ in range(3)]
    docs = []
    for doc in range(60):
        lines = []
        for _ in range(draw.randint(0, 6)):
            words = list(draw.choice(base))
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                words[draw.randrange(len(words))] = draw.choice(rare + common)
            draw.shuffle(words)
            lines.append(draw.choice(["  ", "", "\t"]) + " ".join(words))
        docs.append((doc * 3, "\n".join(lines)))
    long = " ".join(f"w{i}" for i in range(3000))
    return docs + [(500, None), (501, ""), (502, "\n\n \n"), (503, long), (504, long + " more"), (None, base and " ".join(base[0])), (503, long)]


def test_all_and_only_later_matches_go(rows):
    for seed in (1,):
        data = corpus(seed)
        docs = rows([(d, t, 1, "x", 2, "y") for d, t in data], SCHEMA).repartition(3)
        want = removed_lines(data)
        found = sorted(((r.doc_id, r.n_lines, tuple(r.removed_lines)) for r in dedup_report(docs).collect()), key=repr)
        assert found == sorted(((d, len(t.split("\n")), tuple(g)) for (d, t), g in want.items()), key=repr)


def test_texts_without_their_removed_lines(rows):
    data = corpus(3)
    docs = rows([(d, t, 1, "x", 2, "y") for d, t in data], SCHEMA)
    want = removed_lines(data)
    texts = [(d, t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d, t])) for d, t in data]
    out = drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(texts, key=repr)


def test_no_documents(rows):
    assert dedup_report(rows([], SCHEMA)).count() == 0 and drop_repeated_lines(rows([], SCHEMA)).count() == 0


def test_short_lines_go_too(rows):
    """Lines of fewer than five words: equal sets, within a document too, and four words beside the same and a fifth."""
    draw = random.Random(5)
    words = ["All", "rights", "reserved.", "And", "ornd.", "x", "y"]
    data = [(i, "\n".join(" ".join(draw.choices(words, k=draw.randint(0, 6))) for _ in range(3))) for i in range(25)]
    data += [(40, "one\none\n\n\ntwo one\none two"), (41, "one"), (42, "a b c\na b c d"), (43, "a b c d e\nb c d e"), (None, "one\nlast")]
    seen, want = [], {}
    for doc, text in sorted(data, key=lambda x: x[0] if x[0] is not None else 1 << 63):
        sets = [frozenset(line.split()) for line in text.split("\n")]
        gone = []
        for at, found in enumerate(sets):
            if found and any(5 * len(found & s) >= 4 * len(found | s) for s in seen):
                gone.append(at)
            seen.append(found)
        want[doc] = gone
    got = {r.doc_id: r.removed_lines for r in dedup_report(rows([(d, t, 1, "x", 2, "y") for d, t in data], SCHEMA)).collect()}
    assert got == want and got[40] == [1, 5] and got[43] == [0, 1] and got[None] == [0]


def test_a_shared_word_alone_makes_no_pair(rows, monkeypatch):
    """Lines that share a rare word and little else: no pair of them is joined to sets, and no plan spells out the ranks."""
    made, plans = [], []
    matched, keep = lines.matched, lines.Scratch.keep

    def counted(pairs, sets, scratch, what):
        made.append(pairs.count())
        return matched(pairs, sets, scratch, what)

    def described(scratch, df, what):
        plans.append(len(df._jdf.queryExecution().toString()))
        return keep(scratch, df, what)

    monkeypatch.setattr(lines, "matched", counted)
    monkeypatch.setattr(lines.Scratch, "keep", described)
    draw = random.Random(2)
    texts = [f"shared{i // 4} " + " ".join(draw.sample([f"w{j}" for j in range(1000)], 30)) for i in range(400)]
    report = dedup_report(rows([(i, t, 1, "x", 2, "y") for i, t in enumerate(texts)], SCHEMA))
    assert all(r.n_removed == 0 for r in report.collect())
    assert sum(made) < 20 and max(plans) < 500_000


def test_scratch_tables_are_packed(spark, rows):
    """Tables of word hashes that lie beside the exchange by key take no more disk than they must."""
    with lines.Scratch(spark, "lines") as scratch:
        data = [([(7 * i + j % 50) << 40 for j in range(200)],) for i in range(300)]
        kept = scratch.keep(rows(data, "tokens array<bigint>"), "sets")
        assert all(".zstd." in name for name in kept.inputFiles())
        assert sorted(r.tokens for r in kept.collect()) == sorted(t for (t,) in data)


def test_words_of_one_set_are_no_keys(rows):
    """What a rank says occurs once gives no key; later words of the prefix keep their places, and its length."""
    ranks = [(5, 5, 7, 9), (5, 5, 5, 7), (7, 7, 7, 7), (5, 7, 50, 60)]
    data = [(k, [(r << 56) + i for i, r in enumerate(own + (100,) * 6)], 10) for k, own in enumerate(ranks)]
    table = rows(data, "k int, words array<bigint>, n int")
    got = {r.k: [x.at for x in r.found] for r in table.select("k", lines.prefix_keys(lines.F.col("words"), lines.F.col("n")).alias("found")).collect()}
    assert got == {0: [2], 1: [], 2: [0, 1, 2], 3: [1, 2]}


def test_ranks_tell_words_of_one_set_and_are_a_table(rows, monkeypatch):
    """Few words share a slot, and what counted them goes from disk before keys are made."""
    names, keep = [], lines.Scratch.keep
    monkeypatch.setattr(lines.Scratch, "keep", lambda scratch, df, what: names.append(what) or keep(scratch, df, what))
    data = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(30)] + [(40, " ".join(f"w3x{j}" for j in range(11)))]
    got = {r.doc_id: r.n_removed for r in dedup_report(rows(data, "doc_id bigint, text string")).collect()}
    assert sum(got.values()) == got[40] == 1 and names.index("ranks") < names.index("found")


def test_ranks_are_small_and_tell_what_counts_tell(rows):
    """Two bits a slot go through the driver; rank and hash of each word are those that counting gives."""
    draw, slots = random.Random(3), 1 << 14
    word = lambda: draw.randrange(-(1 << 63), 1 << 63)
    common = [word() for _ in range(50)]
    data = [(sorted({*(word() for _ in range(5)), *draw.choices(common, k=draw.randrange(3))}),) for _ in range(2000)]
    sets = rows(data, "tokens array<bigint>")
    ranks = lines.rank_table(sets, slots)
    (held,) = ranks.collect()
    assert len(held.ranks) == slots // 8 and sets.withColumn("x", ranks.scalar()).schema["x"].dataType.simpleString() == "array<smallint>"
    counts = [0] * slots
    slot = lambda w: (w & (1 << 64) - 1) >> 53 << 3 | w & 7
    for w in (w for (tokens,) in data for w in tokens):
        counts[slot(w)] += 1

    def rank(w):
        at = slot(w) // 8 * 8
        total = sum(n for n in counts[at : at + 8] if n > 1)
        return lines.ONCE if counts[slot(w)] == 1 else min(lines.LEVELS, math.floor(4 * math.log2(total + 1))) + 1

    found = lines.by_rarity(lines.F.col("tokens"), lines.F.col("ranks"), slots).alias("found")
    for row in sets.withColumn("ranks", ranks.scalar()).select("tokens", found).collect():
        assert row.found == sorted(rank(w) << 56 | (w & (1 << 64) - 1) >> 8 for w in row.tokens)
