import hashlib
import random

import numpy as np
import pytest

from nameledger.llm import repeats as R

SCHEMA = "doc_id bigint, text string, kind int, sender string, payload int, n_bytes int"


def plain(data):
    key = lambda d: (1 << 63) - 1 if d is None else d
    first = {}
    texts = [(d, (t or "").encode()) for d, t in data]
    for doc, text in texts:
        for i in range(len(text) - 49):
            w = text[i : i + 50]
            first[w] = min(key(doc), first.get(w, 1 << 63))
    out = []
    for doc, text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < key(doc):
                gone[i : i + 50] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randint(1, 6)))
    passages = [" ".join(word() for _ in range(draw.randint(8, 60))) for _ in range(12)] + ["ab" * 60, "x" * 130, "The " * 40]
    data = []
    for doc in range(70):
        parts = [" ".join(word() for _ in range(draw.randint(0, 30))) for _ in range(draw.randint(0, 4))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            a = draw.randrange(len(p))
            parts.insert(draw.randint(0, len(parts)), p[a : a + draw.choice([30, 49, 50, 51, 70, 400])])
        data.append((doc * 5, draw.choice(["", " ", "\n"]).join(parts)))
    data += [(900 + i, data[3][1]) for i in range(5)] + [(2, data[7][1]), (2, data[7][1]), (None, passages[0]), (None, passages[0] + passages[1]), (950, None), (951, ""), (952, "y" * 49), (953, "y" * 49)]
    draw.shuffle(data)
    return data


@pytest.mark.parametrize("seed, bucket", [(1, 400), (2, 8 << 20)])
def test_against_all_windows(rows, monkeypatch, seed, bucket):
    monkeypatch.setattr(R, "BUCKET_BYTES", bucket)
    data = corpus(seed)
    docs = rows([(d, t, 0, "", 0, 0) for d, t in data], SCHEMA).repartition(3)
    assert sorted(map(tuple, R.remove_repeats(docs).collect()), key=repr) == plain(data)


def whole_in_process(data, blob, many, bits=3):
    """The same steps without a cluster, so that sizes can be set small."""
    blobs, at = [], 0
    while at < len(data):
        part = data[at : at + blob]
        blobs.append(R.packed([d for d, _ in part], [(t or "").encode() for _, t in part]))
        at += blob
    anchors = [R.Anchors(b, bits) for b in blobs]
    asked = {}
    for sender, a in enumerate(anchors):
        for bucket, part in a.by_bucket():
            asked.setdefault(bucket, []).append((sender, R.short_hashes(a.distinct[part], a.several[part], bits)))
    shared = [{} for _ in blobs]
    for bucket, parts in asked.items():
        for sender, payload in R.shared_anchors(parts):
            shared[sender][bucket] = payload
    stretches = [a.shared_stretches(x) for a, x in zip(anchors, shared)]
    asked, told, answers = {}, [{} for _ in blobs], [{} for _ in blobs]
    for sender, x in enumerate(stretches):
        for bucket, payload in x.questions():
            asked.setdefault(bucket, []).append((sender, payload))
    for bucket, parts in asked.items():
        for sender, payload in R.answer_hashes(parts):
            told[sender][bucket] = payload
    asked = {}
    for sender, x in enumerate(stretches):
        first, several = x.told(told[sender])
        for bucket, which in x.open_ones(several):
            asked.setdefault(bucket, []).append((sender, R.text_payload(x, which, first)))
    for bucket, parts in asked.items():
        for sender, payload in R.answer_texts(parts):
            answers[sender][bucket] = payload
    out = []
    for sender, a in enumerate(anchors):
        for doc, missing, text, spans in zip(a.ids.tolist(), a.missing, a.texts, R.removed_spans(stretches[sender], told[sender], answers[sender])):
            gone = sum(e - s for s, e in spans)
            kept, last = b"", 0
            for s, e in spans:
                kept, last = kept + text[last:s], e
            out.append((None if missing else doc, len(text), gone, len(spans), hashlib.sha256(kept + text[last:]).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("blob, many, slice_", [(1, 256, 64), (5, 1, 4 << 20), (1000, 256, 1), (9, 3, 300)])
def test_steps_with_small_blobs_and_hot_anchors(monkeypatch, seed, blob, many, slice_):
    monkeypatch.setattr(R, "MANY_BLOBS", many)
    monkeypatch.setattr(R, "SLICE", slice_)
    data = corpus(seed)
    assert whole_in_process(data, blob, many) == plain(data)


def test_ranks_and_smaller_documents():
    draw = random.Random(1)
    data = bytes(draw.choices(b"ab\x00", k=400))
    starts = np.arange(len(data) - R.LENGTH + 1)
    rank = R.window_ranks(np.frombuffer(data, np.uint8), starts)
    order = sorted(set(data[i : i + R.LENGTH] for i in starts))
    assert [order.index(data[i : i + R.LENGTH]) for i in starts] == rank.tolist()
    docs, run = np.array(draw.choices(range(6), k=200)), np.sort(draw.choices(range(9), k=200))
    want = [max((j for j in range(i) if run[j] == run[i] and docs[j] < docs[i]), default=-1) for i in range(200)]
    assert R.nearest_smaller(docs, run).tolist() == want


def test_no_documents(rows):
    assert R.remove_repeats(rows([], SCHEMA)).count() == 0


def test_workers_get_few_rows_at_once(rows, monkeypatch):
    """No step hands a whole task's blobs and answers to its Python worker in one batch; the session's setting stays."""
    given, written = {}, R.written

    def noted(df, what, at_once=None):
        given[what] = at_once
        return written(df, what, at_once)

    monkeypatch.setattr(R, "written", noted)
    docs = rows([(d, t, 0, "", 0, 0) for d, t in corpus(3)], SCHEMA)
    before = docs.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, R.remove_repeats(docs).collect()), key=repr) == plain(corpus(3))
    del given["blobs"]  # documents, not messages
    assert len(given) == 4 and set(given.values()) == {R.ROWS_AT_ONCE}
    assert docs.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
