import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from nameledger.llm import spelling


def apart(a, b):
    """The number of edits between two words, by the plain table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and apart(v, w) == 1] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out)


def some_counts(letters, size, seed, lengths=(5, 9)):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randint(*lengths))) for _ in range(size)}
    for w in list(words)[: size // 2]:
        at = draw.randrange(len(w) + 1)
        words |= {w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:], w[:at] + draw.choice(letters) + w[at + 1 :]}
    return {w: draw.choice([2, 3, 3, 4, 6, 7, 12, 25, 50, 100, 201]) for w in sorted(words)}


@pytest.mark.parametrize("letters,size", [("ab", 150), ("abcé", 300)])
def test_index_finds_exactly_the_near_words(letters, size):
    words = list(some_counts(letters, size, 1, (0, 7)))
    index = spelling.PositionIndex(words)
    for word in words[:120]:
        assert sorted(words[i] for i in index.near(word)) == sorted(w for w in words if apart(w, word) == 1)


def test_near_words_share_a_block():
    words = list(some_counts("abc", 250, 2, (0, 8)))
    for a in words[:200]:
        for b in words:
            if apart(a, b) == 1:
                s = min(len(a), len(b))
                assert any(x == y for x, y in zip(spelling.keys_for(a, s), spelling.keys_for(b, s), strict=True))
        assert len(set(spelling.piece_keys(a))) == len(spelling.piece_keys(a))


@pytest.mark.parametrize("index_words", [8192, 7])
def test_against_all_pairs(spark, monkeypatch, index_words):
    monkeypatch.setattr(spelling, "INDEX_WORDS", index_words)
    counts = some_counts("abÀÿ", 260, 3)
    data = [(w, n - 1, "x") for w, n in counts.items()] + [(w, 1, "y") for w in counts] + [(None, 9, "z")]
    got = spelling.group_variants(spark.createDataFrame(data, "word string, n bigint, near string"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(counts)
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[1] is not None and r[1] != r[2] for r in want)


def test_long_path_to_the_root(spark):
    data = [("a" * i + "b" * (40 - i), 3 * 2**i) for i in range(41)]
    got = {r.word: r.root for r in spelling.group_variants(spark.createDataFrame(data, "word string, n bigint")).collect()}
    assert set(got.values()) == {"a" * 40} and len(got) == 41


def test_runs_of_documents(rows):
    draw = random.Random(6)
    base = ["Straße", "STRASSE", "éTAGE", "étage", "naïve", "word×word", "a", "Ωmega", "letters", "x1y"]
    texts = [(i, " ".join(draw.choices(base, k=draw.randint(0, 60))), i) for i in range(120)]
    texts += [(5000, None, 1), (None, "letters letters", 1), (5001, "", 1), (5002, "letters " * 30_000, 1), (3, texts[3][1], 2), (5003, "y" * 100_000, 1)]
    want = Counter()
    for doc, text, _ in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            want[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    docs = rows(texts, "doc_id bigint, text string, n int")
    got = spelling.run_counts(docs, damage=True)
    assert {r.word: r.n for r in got.collect()} == want
    assert sorted(map(tuple, spelling.group_variants(got).collect())) == plain(want)
    whole = Counter()
    for r in spelling.run_counts(docs).collect():
        whole[r.word] += r.n
    assert sum(whole.values()) == sum(want.values()) and whole["letters"] > want["letters"] - 100


def test_nothing(rows):
    assert spelling.group_variants(rows([], "word string, n bigint")).count() == 0
    assert spelling.run_counts(rows([], "doc_id bigint, text string")).count() == 0
