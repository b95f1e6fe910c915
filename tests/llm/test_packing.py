import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nameledger.llm.packing import WordIds, balanced, differencing, pack_documents, plan_block

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a", "Don't, we'RE fine.. ok., x.,", "<|startoftext|>hi<|endoftext|>", "<|STARTOFTEXT|> A", "é.É, Éa.", "́a ́",
    "a b\tc\r\nd", "ÀB.", "ﬁ. ½.", "I.B.M. U.S., A.", "日本. 한국,", "é. ß.ẞ.", "İ. İstanbul,", "Σας. ΣΑΣ", " . , ..", "<|a.", "word " * 5000,
]


def test_words_one_by_one_give_the_tokenizers_ids():
    own, whole = WordIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text in ODD:
        assert np.frombuffer(own.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_differencing_balances():
    assert sorted(np.bincount(differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    draw = np.random.default_rng(1).integers(1, 100, 300)
    sums = np.bincount(differencing(draw, 40), weights=draw)
    assert len(sums) == 40 and sums.max() - sums.min() <= 5


def test_window_count_rises_until_all_fit():
    lengths = np.array([6, 6, 6])  # three of them make 18 <= 2 * 10, yet no two fit into 10
    of, windows = balanced(lengths, 10)
    assert windows == 3 and np.bincount(of, weights=lengths).max() <= 10


@pytest.mark.parametrize("count", [0, 1, 2, 17, 400])
def test_blocks_cover_every_id_once_without_padding(count):
    draw = random.Random(count)
    lengths = np.array([draw.randint(1, 2047) for _ in range(count)], dtype=np.int64)
    windows = plan_block(lengths, 2048, 1 / 16)
    seen = sorted((i, s, n) for w in windows for i, s, n in w)
    for item, length in enumerate(lengths):
        at = 0
        for _, start, n in (x for x in seen if x[0] == item):
            assert start == at and n > 0
            at += n
        assert at == length
    for window in windows:
        size = sum(n for *_, n in window)
        assert size <= 2048 and size & (size - 1) == 0


def test_pieces_of_documents(rows):
    data = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, None, 1), (1, "twice", 1), (1, "twice", 1)]
    docs = rows(data, "doc_id bigint, text string, offset int").repartition(3)
    got = pack_documents(docs, TOKENIZER).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    for doc, text, _ in data[3 : len(ODD)]:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for piece in sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start):
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            at += piece.length
            assert piece.ids_crc32 == zlib.crc32(ids[piece.start : at].tobytes())
        assert at == len(ids)
    assert sum(r.length for r in got) == sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in data)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_length))
    for parts in sequences.values():
        at = 0
        for offset, length, size in sorted(parts):
            assert offset == at
            at += length
        assert at == size <= 2048


def test_no_documents(rows):
    assert pack_documents(rows([], "doc_id bigint, text string"), TOKENIZER).count() == 0
