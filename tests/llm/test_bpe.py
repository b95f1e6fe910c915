import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from nameledger.llm.bpe import PieceIds, encode_documents, starts_of, stitched

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(3)
    words = ["don't", "we're", "12345", "größe", "日本語", "  ", "\n\n", "!!", "a", "\t", "😀😀", "x" * 70, " " * 60, "'r", "e"]
    made = ["".join(draw.choice(words) + draw.choice([" ", "", "\n"]) for _ in range(n)) for n in (1, 5, 40, 300, 900)]
    return ["", " ", "a", "é", "<|endoftext|>", "x" * 3000, " " * 2000, "ab " * 900, "1" * 777 + "a" * 777, *made]


def expected(encoding, text):
    ids = encoding.encode_ordinary(text)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk, overlap", [(40, 20), (64, 30), (500, 100)])
def test_stitching_finds_the_starts_of_one_scan(chunk, overlap):
    model = PieceIds(RANKS, public_tokenizers.PATTERN)
    for text in texts():
        parts = [(at, text[at : at + chunk + overlap]) for at in range(0, max(1, len(text) - overlap), chunk)]
        chunks = [(at, part, [at + s for s in starts_of(model, part)]) for at, part in parts]
        assert [p for pieces in stitched(model, chunks) for p in pieces] == model.pattern.findall(text)


@pytest.mark.parametrize("chunk, overlap", [(64, 30), (32_768, 1_024)])
def test_documents_as_the_library_encodes_them(rows, encoding, chunk, overlap):
    data = [(i, t, 1, "x") for i, t in enumerate(texts())] + [(None, None, 2, "y"), (3, "again", 3, "z"), (3, "again", 3, "z")]
    docs = rows(data, "doc_id bigint, text string, row int, at string")
    got = encode_documents(docs, RANKS, public_tokenizers.PATTERN, chunk, overlap).collect()
    want = [(i, *expected(encoding, t or "")) for i, t, *_ in data]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_documents(rows):
    assert encode_documents(rows([], "doc_id bigint, text string"), RANKS, public_tokenizers.PATTERN).count() == 0
