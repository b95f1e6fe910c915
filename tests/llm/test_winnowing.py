import hashlib
import random

import numpy as np
import pytest

from nameledger.llm.winnowing import edited, fingerprint_documents, winnow


def test_shared_stretches_share_a_fingerprint():
    draw = random.Random(5)
    letters = "abcdefghij é"
    for _ in range(50):
        shared = "".join(draw.choices(letters, k=50))
        a, b = ("".join(draw.choices(letters, k=draw.randint(0, 90))) + shared + "".join(draw.choices(letters, k=40)) for _ in "ab")
        assert set(winnow(a)[0].tolist()) & set(winnow(b)[0].tolist())


def test_rightmost_minimum_of_each_window():
    hashes, at = winnow("ab" * 40, k=2, window=5)
    runs = {h: [] for h in hashes.tolist()}
    for h, p in zip(hashes.tolist(), at.tolist()):
        runs[h].append(p)
    assert len(runs) == 1  # the lesser of the two runs, always the last one of the window
    assert next(iter(runs.values())) == list(range(at[0], at[-1] + 1, 2))


@pytest.mark.parametrize("parts", [1, 5])
def test_every_row_meets_the_next_one(spark, rows, parts):
    draw = random.Random(2)
    texts = ["".join(draw.choices("abcd éü\n", k=n)) for n in (0, 1, 3, 30, 49, 51, 200, 4000)] + [None, ""]
    data = [(i * i * 7 + 3, t, i) for i, t in enumerate(texts)] + [(10**15, "far", 0), (10**15, "away", 0), (None, "none", 0)]
    draw.shuffle(data)
    docs = rows(data, "doc_id bigint, text string, part int").repartition(parts)
    got = fingerprint_documents(docs).collect()
    order = sorted(((-(1 << 63) if d is None else d), t or "", d) for d, t, _ in data)
    want = []
    for n, (_, text, doc) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        changed = edited(text, following)
        a, b, c = (set(winnow(x)[0].tolist()) for x in (text, changed, following))
        near = [1.0 if not a | x else len(a & x) / len(a | x) for x in (b, c)]
        sha = hashlib.sha256(changed.encode()).hexdigest()
        want.append((doc, len(text), sha, winnow(text)[0].astype(">u4").tobytes().hex(), *near))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_edges(rows):
    assert fingerprint_documents(rows([], "doc_id bigint, text string")).count() == 0
    [one] = fingerprint_documents(rows([(1, "abcdefgh")], "doc_id bigint, text string")).collect()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"abcdefab").hexdigest())
    assert np.all(winnow("x" * 500)[1] >= 0)
