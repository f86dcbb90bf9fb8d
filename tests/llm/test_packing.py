from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gondola.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, length):
    """Sequences are full from 0 on without gaps, and no longer than allowed."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= length
    return len(by)


def test_pieces_are_whole_documents(small):
    library = Tokenizer.from_file(PATH)
    rows = packing.pack_documents(small, PATH, keep_ids=True).collect()
    texts = {r.doc_id: r.text for r in small.collect()}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == texts.keys()
    for doc_id, pieces in by.items():
        pieces.sort(key=lambda r: r.piece)
        ids = np.array([*library.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert b"".join(bytes(p.ids) for p in pieces) == ids.tobytes()
        assert all(p.length == 2048 for p in pieces[1:]) and 0 < pieces[0].length <= 2048
        for p in pieces:
            own = ids[p.start : p.start + p.length].tobytes()
            assert bytes(p.ids) == own and p.ids_crc32 == zlib.crc32(own)
    made = check(rows, 2048)
    assert made <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_many_tasks_fill_as_well(spark, small):
    pieces = packing.cut_pieces(small, PATH)
    rows = packing.pack(pieces, 2048, task_pieces=20).collect()
    assert len(rows) == pieces.count()
    assert check(rows, 2048) <= 1.05 * sum(r.length for r in rows) / 2048 + 2


def test_odd_rows(odd, empty):
    rows = packing.pack_documents(odd, PATH, length=64).collect()
    check(rows, 64)
    assert sum(r.start == 0 for r in rows) == odd.count()
    blank = [r for r in rows if r.doc_id == 3]
    assert [(r.piece, r.start, r.length) for r in blank] == [(0, 0, 1)]
    assert packing.pack_documents(empty, PATH).count() == 0


def test_long_white_space(spark):
    """Runs that the library's word pattern gives up on."""
    library = Tokenizer.from_file(PATH)
    texts = [" " * 2_000_000 + "x", "a <|endoftext|>" + "\n" * 1_200_000 + "x y", "end" + " \t" * 1_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH, keep_ids=True).collect()
    check(rows, 2048)
    for k, text in enumerate(texts):
        own = b"".join(bytes(r.ids) for r in sorted((r for r in rows if r.doc_id == k), key=lambda r: r.piece))
        assert own == np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes()


def brute(sizes, length):
    """Sum-of-squares packing by trying every place."""
    bins, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        best = None
        for b in [*range(len(bins)), None]:
            gaps = bins.copy()
            if b is None:
                gaps.append(length)
            at = len(bins) if b is None else b
            gaps[at] -= sizes[i]
            if gaps[at] < 0:
                continue
            squares = sum(n * n for g, n in zip(*np.unique([g for g in gaps if g], return_counts=True), strict=True))
            key = (squares, b is None, bins[b] if b is not None else length)
            if best is None or key < best[0]:
                best = (key, gaps)
        bins = best[1]
        out[i] = None
    return sorted(bins)


def test_places_minimise_the_sum_of_squares():
    rng = np.random.default_rng(4)
    for length in (8, 20, 50):
        sizes = rng.integers(1, length + 1, 60)
        bins, offsets = packing.place(sizes, length)
        left = np.full(bins.max() + 1, length)
        np.subtract.at(left, bins, sizes)
        assert sorted(left.tolist()) == brute(sizes.tolist(), length)
        assert (left >= 0).all() and (offsets >= 0).all()
