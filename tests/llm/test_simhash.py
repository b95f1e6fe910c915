import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from nameledger.llm.components import components
from nameledger.llm.simhash import MASKS, fingerprint, link_fingerprints, near_groups, near_pairs, one_of_each, signed


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts():
    draw = random.Random(8)
    words = [f"word{i}" for i in range(500)] + ["Ä", "É", "İ", "a\x85b"]
    base = [" ".join(draw.choices(words, k=n)) for n in (1, 2, 3, 4, 50, 400, 400, 800)]
    near = []
    for text in base[4:]:
        for _ in range(6):
            parts = text.split(" ")
            parts[draw.randrange(len(parts))] = "changed"
            near.append(" ".join(parts))
    return base + near + base[:5] + ["", " \n", "A b C", "a B c", "one", "two"]


def find(links, nodes):
    part = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    return part


def test_fingerprints_of_words():
    for text in texts():
        assert fingerprint(text) == plain_fingerprint(text)


def test_selections_cover_every_pair_of_errors():
    assert len(MASKS) == 27 and min(m.bit_count() for m in MASKS) >= 64 - 20
    for i in range(64):
        for j in range(i, 64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in MASKS)


@pytest.mark.parametrize("at_once", [4, 1 << 18])
def test_trie_walk_finds_all_near_pairs(monkeypatch, at_once):
    monkeypatch.setattr("nameledger.llm.simhash.PAIRS_AT_ONCE", at_once)
    draw = random.Random(1)
    seeds = [draw.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    made = {s ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 3))) & (1 << 64) - 1 for s in seeds for _ in range(40)}
    values = np.sort(np.array(list(made), dtype=np.uint64))
    got = sorted((int(a), int(b)) for x in near_pairs(values, np.zeros(len(values), int)) for a, b in zip(*x))
    want = [(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 2]
    assert got == want


def test_links_of_fingerprints_once_each(rows):
    draw = random.Random(7)
    seeds = [draw.getrandbits(64) for _ in range(20)]
    made = sorted({s ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for s in seeds for _ in range(15)})
    got = [(r.a, r.b) for r in link_fingerprints(rows([(signed(m),) for m in made], "fp bigint")).collect()]
    want = {frozenset((signed(a), signed(b))) for i, a in enumerate(made) for b in made[i + 1 :] if (a ^ b).bit_count() <= 2}
    assert len(got) == len(want) and set(map(frozenset, got)) == want


def test_components_of_chains_and_stars(rows):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 3), (200, 200), (300, 299)]
    got = {r.node: r.component for r in components(rows(links, "a bigint, b bigint")).collect()}
    want = find([x for x in links if x[0] != x[1]], {n for x in links if x[0] != x[1] for n in x})
    assert got == want
    assert components(rows([], "a bigint, b bigint")).count() == 0


def test_groups(rows):
    data = [(3 * i, t, 0, "c") for i, t in enumerate(texts())] + [(999, None, 0, "c"), (6, "again", 0, "c"), (6, "again", 0, "c")]
    docs = rows(data, "doc_id bigint, text string, fp int, component string")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in near_groups(docs).collect()]
    prints = [plain_fingerprint(t or "") for _, t, *_ in data]
    distinct = set(prints)
    links = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2]
    part = find(links, distinct)
    least = {}
    for (doc, *_), p in zip(data, prints):
        least[part[p]] = min(doc, least.get(part[p], doc))
    assert sorted(got) == sorted((doc, f"{p:016x}", least[part[p]]) for (doc, *_), p in zip(data, prints))


def test_one_of_each_group_stays(rows):
    data = [(3 * i, t, 0, "c") for i, t in enumerate(texts())] + [(None, "alone with no id", 0, "c"), (None, texts()[5], 0, "c"), (0, texts()[0], 0, "c"), (0, texts()[0], 0, "c")]
    docs = rows(data, "doc_id bigint, text string, __id int, part string")
    groups = {}
    for r in near_groups(docs).collect():
        groups.setdefault((r.component_id, r.doc_id is None and r.component_id is None), set()).add(r.doc_id)
    out = one_of_each(docs.drop("__id"))
    assert out.columns == ["doc_id", "text", "part"]
    kept = [r.doc_id for r in out.collect()]
    assert sorted(kept, key=repr) == sorted((c for c, _ in groups), key=repr)


def test_edges(rows):
    assert one_of_each(rows([], "doc_id bigint, text string")).count() == 0
    assert near_groups(rows([], "doc_id bigint, text string")).count() == 0
    [one] = near_groups(rows([(None, "a b c")], "doc_id bigint, text string")).collect()
    assert one.component_id is None
