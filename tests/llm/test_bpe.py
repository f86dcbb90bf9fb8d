from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gondola.llm import bpe, packing
from gondola.llm.words import cut_words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_whole_table_equals_library(small, library):
    rows = bpe.encode_decode(small, PATH).join(small.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == small.count()
    for r in rows:
        assert bytes(r.ids) == expected(library, r.text)
        assert r.decoded == library.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) == r.text


def test_odd_rows(odd, empty, library):
    rows = bpe.encode_decode(odd, PATH).collect()
    texts = [r.text for r in odd.collect()]
    assert sorted(bytes(r.ids) for r in rows) == sorted(expected(library, t) for t in texts)
    assert sorted(r.decoded for r in rows) == sorted(t or "" for t in texts)
    assert bpe.encode_decode(empty, PATH).columns == ["doc_id", "ids", "decoded"]
    assert bpe.encode_decode(empty, PATH).count() == 0


def test_mixed_characters_equal_library(library):
    rng = random.Random(3)
    parts = ["a", "b", "'", "s", "'s", "'ll", "'re", " ", "  ", "\n", "\t", "é", "ß", "1", "²", "!", "<|endoftext|>", " ", "　", "日本", "😀", "́", "the", " and", "\x1c", "\x85", "Ɤ", "\U000105c0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    vocab = bpe.vocabulary(PATH)
    found = bpe.encode_texts([t.encode() for t in texts], vocab.cache, vocab.learn, vocab.special)
    assert found == [expected(library, t) for t in texts]
    coder = packing.encoding(PATH)
    assert found == [coder.encode_to_numpy(t, allowed_special="all").astype("<u4").tobytes() for t in texts]


def test_proposals_are_checked_and_mended():
    vocab = bpe.vocabulary(PATH)
    rng = random.Random(5)
    words = [bytes(rng.choices(b"abehinorst", k=rng.randint(2, 12))) for _ in range(2000)]
    failing = 0
    for w in words:
        proposed = np.array(vocab.propose(w))
        fine = vocab.compatible(proposed[:-1], proposed[1:]).all()
        assert fine == (proposed.tolist() == vocab.merge(w))
        failing += not fine
    assert 0 < failing < len(words)


def test_compatible_is_what_merging_says():
    vocab = bpe.vocabulary(PATH)
    rng = np.random.default_rng(2)
    known = np.array(sorted(vocab.ids.values()))
    a, b = rng.choice(known[:3000], 1500), rng.choice(known[:3000], 1500)
    merged = [vocab.merge(vocab.token[x] + vocab.token[y]) == [x, y] for x, y in zip(a, b, strict=True)]
    assert vocab.compatible(a, b).tolist() == merged


def test_words_are_those_of_the_library(library):
    text = "It's  a\n\n test:  we'll   see 'sand' x'S \t1st²  "
    joined, at, counts = cut_words([text.encode(), b"", b"ab "])
    own = [joined[a:b].decode() for a, b in zip(at, at[1:], strict=False)]
    assert counts.tolist()[1:] == [0, 2]
    ends = [e for _, (_, e) in library.pre_tokenizer.pre_tokenize_str(text)]
    starts = [0, *ends[:-1]]
    assert own[: counts[0]] == [text[a:b] for a, b in zip(starts, ends, strict=True)]


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 50)
    vocab, rng = bpe.vocabulary(PATH), random.Random(6)
    parts = ["word", "it's", " ", " a", " b1", "\n", "  ", "é ", "<|endoftext|>", "!", "9"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 300))) for _ in range(300)]
    assert any(len(list(bpe.split_long(t.encode()))) > 3 for t in texts)
    found = bpe.encode_texts([t.encode() for t in texts], vocab.cache, vocab.learn, vocab.special)
    assert found == [expected(library, t) for t in texts]
