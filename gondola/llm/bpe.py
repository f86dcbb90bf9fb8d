"""BPE encoding and decoding: greedy proposals, checked pair by pair, merged only where they fail.

A sequence of tokens is the BPE encoding of a word exactly if each token is the encoding of its
own bytes and every two neighbours, encoded together, stay those two. So the longest matches are
proposed, all adjacent pairs of a batch of new words are checked at once, and only words with a
failing pair are merged by rank.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gondola.llm.base import raw, slices
from gondola.llm.words import cut_words

#: Words that a worker remembers before it starts anew.
REMEMBERED = 400_000
NEVER = np.int64(1) << 40
#: Longer texts are encoded in parts of about so many bytes.
PART_BYTES = 1 << 20
CUT = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z])")


def byte_of_sign() -> dict[str, int]:
    """Printable sign of each byte in a byte-level vocabulary: itself where it is printable, else
    the next unused code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file; ids follow the merge order."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        signs = byte_of_sign()
        vocab = content["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in content["added_tokens"]}
        size = max(max(vocab.values()), *self.special.values(), 0) + 1
        self.token: list[bytes] = [b""] * size
        for word, i in vocab.items():
            self.token[i] = bytes(signs[c] for c in word)
        for word, i in self.special.items():
            self.token[i] = word
        self.base = {self.token[i][0]: i for i in vocab.values() if len(self.token[i]) == 1}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        a, b, c = (np.array(x, np.int64) for x in zip(*((vocab[x], vocab[y], vocab[x + y]) for x, y in pairs), strict=True))
        if (np.diff(c) <= 0).any() or c.min() < len(self.base):
            raise ValueError("ids must follow the order of the merges")
        self.merged = dict(zip(zip(a.tolist(), b.tolist(), strict=True), c.tolist(), strict=True))
        order = np.argsort((a << 32) | b)
        self.pair_keys, self.pair_ids = ((a << 32) | b)[order], c[order]
        self.left, self.right = np.arange(size), np.arange(size)
        self.left[c], self.right[c] = a, b
        self.bytes = len(self.base)
        # Only tokens that their own bytes are encoded as can be proposed.
        known = [i for i in sorted(vocab.values()) if i < self.bytes or self.merge(self.token[i]) == [i]]
        self.ids = {self.token[i]: i for i in known}
        self.longest: dict[bytes, int] = {}
        for t in self.ids:
            self.longest[t[:2]] = max(self.longest.get(t[:2], 1), len(t))
        self.flat = np.frombuffer(b"".join(self.token), np.uint8)
        self.width = np.array([len(t) for t in self.token], np.int64)
        self.at = np.cumsum(self.width) - self.width
        self.cache: dict[bytes, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: again and again the pair of lowest rank, the leftmost first."""
        ids: list[int | None] = [self.base[b] for b in word]
        n, merged = len(ids), self.merged
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(m, i) for i in range(n - 1) if (m := merged.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or merged.get((ids[i], ids[j])) != m:
                continue
            ids[i], ids[j] = m, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if x := merged.get((m, ids[k])):
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := merged.get((ids[h], m))):
                heapq.heappush(heap, (x, h))
        return [i for i in ids if i is not None]

    def propose(self, word: bytes) -> list[int]:
        """Longest matches from the left."""
        ids, longest, out, i, n = self.ids, self.longest, [], 0, len(word)
        while i < n:
            j = min(n, i + longest.get(word[i : i + 2], 1))
            while (t := ids.get(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b, encoded together, stay a and b. The younger of the two is undone
        step by step; had the parts that then meet been merged earlier, they would not stay."""
        good, left = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.full(len(a), NEVER)
        while len(left):
            key = (a << 32) | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            bad = (self.pair_keys[at] == key) & (self.pair_ids[at] < limit)
            good[left[bad]] = False
            go = ~bad & (np.maximum(a, b) >= self.bytes)
            left, a, b = left[go], a[go], b[go]
            first = a > b
            limit = np.where(first, a, b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    def learn(self, words: list[bytes]) -> None:
        """Encode new words into the cache."""
        found = [self.propose(w) for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for f in found for i in f), np.int64, int(counts.sum()))
        ends = np.cumsum(counts)
        inner = np.ones(len(ids), bool)
        inner[ends - 1] = False
        at = np.flatnonzero(inner)
        pairs, back = np.unique((ids[at] << 32) | ids[at + 1], return_inverse=True)
        failing = at[~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]]
        wrong = set(np.searchsorted(ends, failing, side="right").tolist())
        flat = ids.astype("<u4").tobytes()
        start = 0
        for k, (word, end) in enumerate(zip(words, (4 * ends).tolist(), strict=True)):
            self.cache[word] = pack(f"<{len(m := self.merge(word))}I", *m) if k in wrong else flat[start:end]
            start = end

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all tokens, and the end of each."""
        widths = self.width[ids]
        ends = np.cumsum(widths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.at[ids] - (ends - widths), widths) + np.arange(total)].tobytes(), ends


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(texts: list[bytes], cache: dict[bytes, bytes], learn: Callable[[list[bytes]], None], special: dict[bytes, int]) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text. ``learn`` puts new words into ``cache``."""
    parts, owner = texts, None
    if any(len(t) > PART_BYTES or any(s in t for s in special) for t in texts):
        parts, owner = [], []
        for k, t in enumerate(texts):
            for piece in split_special(t, special):
                for part in split_long(piece) if isinstance(piece, bytes) else [piece]:
                    parts.append(part)
                    owner.append(k)
    plain = parts if owner is None else [p if isinstance(p, bytes) else b"" for p in parts]
    joined, offsets, counts = cut_words(plain)
    at = offsets.tolist()
    words = [joined[a:b] for a, b in zip(at, at[1:], strict=False)]
    if len(cache) > REMEMBERED:
        cache.clear()
    ids = list(map(cache.get, words))
    missing = [i for i, x in enumerate(ids) if x is None]
    if missing:
        learn(list({words[i] for i in missing}))
        for i in missing:
            ids[i] = cache[words[i]]
    ends = np.cumsum(counts).tolist()
    out = [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
    if owner is None:
        return out
    whole: list[list[bytes]] = [[] for _ in texts]
    for k, piece, encoded in zip(owner, parts, out, strict=True):
        whole[k].append(encoded if isinstance(piece, bytes) else int(piece).to_bytes(4, "little"))
    return [b"".join(w) for w in whole]


def split_long(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut before a blank between a letter or digit and a letter: a word
    begins there whatever else stands around it."""
    start = 0
    while len(text) - start > PART_BYTES and (found := CUT.search(text, start + PART_BYTES)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def split_special(text: bytes, special: dict[bytes, int]) -> Iterator[bytes | int]:
    """The text between special tokens, and their ids; the leftmost, then the longest, wins."""
    start = 0
    while True:
        found = min(((at, -len(s), s) for s in special if (at := text.find(s, start)) >= 0), default=None)
        if found is None:
            yield text[start:]
            return
        yield text[start : found[0]]
        yield special[found[2]]
        start = found[0] + len(found[2])


def _encode_decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    for batch in batches:
        for part in slices(batch, "text"):
            encoded = encode_texts(raw(part.column("text")), vocab.cache, vocab.learn, vocab.special)
            ids = np.frombuffer(b"".join(encoded), "<u4")
            decoded, ends = vocab.decode(ids)
            upto = np.cumsum([len(e) // 4 for e in encoded])
            stops = np.concatenate([[0], ends])[upto].tolist()
            texts = [decoded[a:b].decode("utf-8", "replace") for a, b in zip([0, *stops], stops, strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(encoded, pa.binary()), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Ids and decoded text of every whole text: (doc_id, ids, decoded).

    ``ids`` are little-endian unsigned 32-bit numbers. Strings of special tokens become those
    tokens; no token is added. A null text counts as empty: no ids, empty text. One row per input
    row, repeated rows and null doc_ids included; other columns don't matter. ``path``: the
    vocabulary file, present on every executor. No shuffle: rows are encoded where they are read.
    """
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(_encode_decode, path=path), f"doc_id {kind}, ids binary, decoded string")
