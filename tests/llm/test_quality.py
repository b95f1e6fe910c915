import math
import random
import re
from collections import Counter

import pytest

from nameledger.llm import quality as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def classes(text):
    n = [0] * 7
    for c in text:
        kind = 0 if "A" <= c <= "Z" else 1 if "0" <= c <= "9" else 2 if c in " \t\n\x0b\x0c\r" else 3 if c in "#*$%&|<>" else 5 if ord(c) > 127 else 4 if re.match(r"[!\"'()+,\-./:;=?@\[\\\]^_`{}~]", c) else 6
        n[kind] += 1
    return n


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def texts():
    draw = random.Random(4)
    small, large = ["the", "of", "a", "in", "Und", "é"], [f"w{i}" for i in range(300)] + ["the", "of", "and", "is"]
    made = []
    for n in (0, 1, 2, 3, 4, 10, 49, 50, 51, 200, 3000):
        for pool in (small, large):
            made.append("".join(draw.choice(pool) + draw.choice([" ", " ", "\n", "\t\x0b", "  ", ". ", " # "]) for _ in range(n)))
    made += [" \n\t ", "\n", "a b c a b c", "x y z " * 40, "SHOUT!! " * 60, "q&&& r$$$ " * 60, "one line here\n" * 30, "\x1d a\x85b c"]
    return made


@pytest.fixture(scope="module")
def judged(spark):
    data = [(i, t, ["en", "de", "xx", None][i % 4], "k") for i, t in enumerate(texts())] + [(None, None, "en", "k"), (0, "", "en", "k")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, kept string")
    return data, docs, Q.judge(docs).collect()


def test_base_counts(judged):
    data, _, got = judged
    want = sorted(((d, *counts(t)) for d, t, *_ in data), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_distances_and_verdict(judged):
    data, _, got = judged
    sums = {}
    key = lambda lang: lang if lang in Q.COMMON_WORDS else Q.OTHER
    common = lambda text, lang: [WORD.findall(text).count(w) for w in (Q.COMMON_WORDS.get(lang) or Q.ALL_WORDS)]
    for _, text, lang, _ in data:
        a, b = sums.setdefault(key(lang), ([0] * 7, [0] * (1 + len(Q.COMMON_WORDS.get(lang) or Q.ALL_WORDS))))
        a[:] = [x + y for x, y in zip(a, classes(text or ""))]
        own = common(text or "", lang)
        b[:] = [x + y for x, y in zip(b, [*own, len(WORD.findall(text or "")) - sum(own)])]
    by_id = {r.doc_id: r for r in got if r.n_words}
    checked = 0
    for doc, text, lang, _ in data:
        r = by_id.get(doc)
        if r is None or not text:
            continue
        guard = r.n_words >= 50 and r.word_chars >= 200 and sum(sums[key(lang)][1]) >= 1000
        assert (r.char_distance is not None) == guard
        if guard:
            own = common(text, lang)
            near = js(classes(text), sums[key(lang)][0]), js([*own, len(WORD.findall(text)) - sum(own)], sums[key(lang)][1])
            assert (r.char_distance, r.word_distance) == pytest.approx(near, abs=1e-9)
            assert r.kept == (not r.base_failed and near[0] <= Q.MOST_CHAR_DISTANCE and near[1] <= Q.MOST_WORD_DISTANCE)
            checked += 1
        else:
            assert r.kept == (not r.base_failed)
    assert checked >= 3


def test_stage_keeps_whole_rows(judged):
    data, docs, got = judged
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_no_documents(rows):
    docs = rows([], "doc_id bigint, text string, lang string")
    assert Q.judge(docs).count() == 0 and Q.keep_good(docs).count() == 0
