from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from gondola.llm.token_counts import Counter, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_whole_table_equals_library(small, library):
    rows = count_tokens(small, PATH, chunk=512, overlap=16).join(small.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == small.count()
    assert all(r.n_tokens == len(library.encode(r.text)) and r.n_bytes == len(r.text.encode()) for r in rows)
    assert sum(r.n_chunks > 2 for r in rows) > 20


def test_odd_rows(odd, empty, library):
    rows = count_tokens(odd, PATH).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == sorted((len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in odd.collect())
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {0}
    assert count_tokens(empty, PATH).count() == 0


@pytest.mark.parametrize(("chunk", "overlap"), [(16, 4), (40, 6), (100, 10)])
def test_splices_and_widens(library, chunk, overlap):
    own, rng = Counter(PATH, chunk, overlap), random.Random(chunk)
    parts = ["a", "ab", "▁", "  ", "    ", " ", "\n", "é", "日本", "😀", "<s>", "</s>", "<0x41>", "hello", "\x00", "th", "e", "́", "xxxxx"]
    widened = 0
    for k in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 120))) if k % 10 else rng.choice(["aaaa", " ", "\n"]) * rng.randint(1, 100)
        tokens, _, wide = own.count([text])[0]
        assert tokens == len(library.encode(text))
        widened += wide
    assert widened


def test_overlap_must_be_shorter(small):
    with pytest.raises(ValueError):
        count_tokens(small, PATH, chunk=10, overlap=10)
