"""Token counts of whole texts by a sentence-piece model; huge texts in overlapping chunks.

No piece of the model holds certain pairs of neighbouring characters, so no merge ever joins them:
a boundary between them is stable whatever stands around it. Neighbouring chunks overlap, and are
spliced at a stable boundary where both encodings end a token. Without one the overlap is widened,
at last to the whole of both chunks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from gondola.llm.base import slices

BLANK = "▁"  # stands for a blank in pieces
BYTE = re.compile(r"<0x[0-9A-F]{2}>")


class Counter:
    """Counts tokens; ``chunk`` and ``overlap`` in characters."""

    def __init__(self, path: str, chunk: int, overlap: int) -> None:
        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        spec = model.normalizer_spec
        normal = sentencepiece_model_pb2.ModelProto.SentencePiece.NORMAL
        # Chunks can be encoded alone if the text is taken as it is and pieces only come of merges.
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces and model.trainer_spec.byte_fallback and not model.trainer_spec.treat_whitespace_as_suffix and all(p.type not in (4, 5) for p in model.pieces)
        self.prefix = spec.add_dummy_prefix
        spec.add_dummy_prefix = False
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.joined = {p.piece[i : i + 2] for p in model.pieces if p.type == normal for i in range(len(p.piece) - 1)}
        self.chunk, self.overlap = chunk, overlap

    def ends(self, text: str, start: int) -> list[int]:
        """Where the tokens of ``text`` end, in characters from ``start`` on; each character that
        falls back to bytes ends with its last byte, earlier bytes with it."""
        out, at = [], start
        wait = 0
        for piece in self.inner.encode(text, out_type=str):
            if BYTE.fullmatch(piece):
                if not wait:
                    wait = max(1, len(text[at - start].encode()))
                    at += 1
                wait -= 1
            else:
                at += len(piece)
            out.append(at)
        return out

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1] not in self.joined

    def huge(self, text: str) -> tuple[int, int, int]:
        """(tokens, chunks, widened overlaps) of a text longer than a chunk."""
        text = (" " + text if self.prefix else text).replace(" ", BLANK)
        n, tokens, chunks, widened = len(text), 0, 1, 0
        start, stop = 0, self.chunk
        ends = self.ends(text[:stop], 0)
        done = 0  # tokens up to here are counted
        while stop < n:
            overlap, found = self.overlap, None
            following = min(n, stop + max(self.chunk, stop - done))  # what can't be spliced is doubled
            while found is None and overlap < stop - done:
                begin = stop - overlap
                later = self.ends(text[begin:following], begin)
                common = set(later)
                found = next((e for e in reversed(ends) if begin < e < stop and e in common and self.stable(text, e)), None)
                if found is None:
                    overlap *= 2
                    widened += 1
            if found is None:  # nothing to splice at: both chunks as one
                later, found = self.ends(text[done:following], done), done
                widened += 1
            tokens += sum(done < e <= found for e in ends)
            ends, done, stop = [e for e in later if e > found], found, following
            chunks += 1
        return tokens + len(ends), chunks, widened

    def count(self, texts: list[str]) -> list[tuple[int, int, int]]:
        small = [t for t in texts if len(t) <= self.chunk or not self.plain]
        counts = iter([len(x) for x in self.whole.encode(small, num_threads=1)] if small else [])
        return [(next(counts), 1, 0) if len(t) <= self.chunk or not self.plain else self.huge(t) for t in texts]


@lru_cache(maxsize=4)
def counter(path: str, chunk: int, overlap: int) -> Counter:
    return Counter(path, chunk, overlap)


def _count(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    own = counter(path, chunk, overlap)
    for batch in batches:
        for part in slices(batch, "text"):
            texts = [t or "" for t in part.column("text").to_pylist()]
            tokens, chunks, widened = zip(*own.count(texts), strict=True)
            arrays = [pa.array(x, pa.int64()) for x in ([len(t.encode()) for t in texts], tokens, chunks, widened)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_tokens", "n_chunks", "n_widened"])


def count_tokens(docs: DataFrame, path: str, chunk: int = 8192, overlap: int = 128) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_chunks, n_widened) of every whole text, one row per row.

    Counts are those of the whole text without begin or end tokens; strings of control tokens in a
    text are ordinary text. A null text counts as empty: no bytes, no tokens. Repeated rows and
    null doc_ids stay; other columns don't matter. Where the model changes its input before
    encoding, texts are encoded whole. No shuffle: rows are counted where they are read.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(_count, path=path, chunk=chunk, overlap=overlap), f"doc_id {kind}, n_bytes long, n_tokens long, n_chunks long, n_widened long")
