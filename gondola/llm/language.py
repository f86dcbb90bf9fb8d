"""Language of every text: scripts narrow the candidates, words are scored, spans are decoded.

A word's letters tell its script, and only languages learned in that script are candidates. Each
word gets a score per candidate from its character n-grams. The best path over the words of a text
pays a penalty for each change of language; it labels the spans of a mixed text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.base import slices



def _marks() -> str:
    """All combining marks, as the inside of a character class."""
    points = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "M"]
    starts = [c for k, c in enumerate(points) if k == 0 or points[k - 1] != c - 1]
    ends = [c for k, c in enumerate(points) if k + 1 == len(points) or points[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in zip(starts, ends, strict=True))


#: A letter, then letters and the marks that belong to them: Indic and Thai words stay whole.
WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")
#: First code points of ranges of scripts; 0 is Latin, -1 other.
SCRIPTS = [(0x00, 0), (0x250, -1), (0x370, 1), (0x400, 2), (0x530, 3), (0x590, 4), (0x600, 5), (0x700, -1), (0x750, 5), (0x780, -1), (0x900, 6), (0x980, 7), (0xA00, 8), (0xA80, 9), (0xB00, 10), (0xB80, 11), (0xC00, 12), (0xC80, 13), (0xD00, 14), (0xD80, 15), (0xE00, 16), (0xE80, 17), (0xF00, 18), (0x1000, 19), (0x10A0, 20), (0x1100, 21), (0x1200, 22), (0x13A0, -1), (0x1780, 23), (0x1800, -1), (0x1E00, 0), (0x1F00, 1), (0x2000, -1), (0x3040, 24), (0x3100, -1), (0x3400, 25), (0xA000, -1), (0xAC00, 21), (0xD7B0, -1), (0xF900, 25), (0xFB00, 0), (0xFB13, 3), (0xFB1D, 4), (0xFB50, 5), (0xFE00, -1), (0xFE70, 5), (0xFF00, 0), (0xFF66, 24), (0xFFA0, 21), (0xFFE0, -1), (0x20000, 25), (0x32000, -1)]
STARTS = [s for s, _ in SCRIPTS]
KINDS = 26
#: Buckets of hashed n-grams of 1 to 3 characters.
BUCKETS = 1 << 16
#: Most that one word may speak against a language, and the penalty of a change, in natural logs.
MOST_PER_WORD, PENALTY = 6.0, 12.0
#: Labelled rows that a model is learned from, about, and of a single language at least, if there
#: are so many; bounds for the fit only.
SAMPLE, LEAST = 10_000, 200
#: Different languages that can be learned: the model has a row of weights for each.
LANGUAGES = 500
#: Words that a worker remembers before it starts anew.
REMEMBERED = 400_000


def script_of(word: str) -> int:
    """Script of a word's first letter, or -1."""
    return SCRIPTS[bisect_right(STARTS, ord(word[0])) - 1][1]


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the lower-cased words with marks around them, and which word each
    belongs to."""
    marked = ["\x02" + w.lower() + "\x03" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), sizes)
    codes, owners = [], []
    value = points.copy()
    for n in (1, 2, 3):
        if n > 1:
            value = value[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        same = owner[: len(value)] == owner[n - 1 :]
        codes.append(((value[same] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64))
        owners.append(owner[: len(value)][same])
    return np.concatenate(codes), np.concatenate(owners)


@dataclass
class Model:
    """``weights``: log probability of each bucket per language; ``scripts``: which scripts a
    language is written in."""

    langs: list[str]
    weights: np.ndarray
    scripts: np.ndarray
    name: str = field(default_factory=lambda: uuid4().hex)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words per language, the best 0 and others down to -MOST_PER_WORD, and the
        number of letters."""
        codes, owners = gram_buckets(words)
        scores = np.stack([np.bincount(owners, w[codes], len(words)) for w in self.weights], 1) / 2
        kinds = np.array([script_of(w) for w in words])
        allowed = self.scripts[:, kinds].T
        allowed = allowed | ~allowed.any(1, keepdims=True)
        scores = np.where(allowed, scores, -np.inf)
        scores = np.maximum(scores - scores.max(1, keepdims=True), -MOST_PER_WORD)
        letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], np.int64)
        return scores * (letters > 0)[:, None], letters


def _count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            words = WORD.findall(text)
            if words:
                own = sums.setdefault(lang, np.zeros(BUCKETS + KINDS + 1, np.int64))
                own += np.bincount(np.append(gram_buckets(words)[0], BUCKETS + np.array([script_of(w) for w in words]) % (KINDS + 1)), minlength=len(own))
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": own[at]})


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from (doc_id, text, lang) rows with both text and lang: all rows, or where there are
    more than ``sample``, about so many, but of no language fewer than ``LEAST`` on that account.
    They are chosen by hash of doc_id and text: neither the table's layout nor the order of its rows
    changes the model, and copies of a text don't all come in. What reaches the driver is one number
    per language and bucket; more than ``LANGUAGES`` languages are an error."""
    rows = labelled.where("text is not null and lang is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    n = sum(sizes.values())
    if n > sample:
        shares = {lang: min(1.0, max(sample / n, LEAST / own)) for lang, own in sizes.items()}
        share = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col("lang"))
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share * float(1 << 30))
    counted = rows.select("lang", "text").mapInPandas(_count_grams, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS + KINDS + 1))
    counts[[langs.index(x) for x in counted["lang"]], counted["bucket"]] = counted["n"]
    grams = counts[:, :BUCKETS] + 0.05
    used = counts[:, BUCKETS:] > 0.01 * counts[:, BUCKETS:].sum(1, keepdims=True)
    return Model(langs, np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32), used)


def best_path(scores: np.ndarray) -> np.ndarray:
    """Language of each word on the best path, for ``scores`` with a row for each language.

    The path is constant, in the language that is best in all, if no stretch of words gains more
    for another language than a penalty, and the best beginning and the best end together gain no
    more either: any other path loses at its changes what it gains on its stretches.
    """
    best = int(scores.sum(1).argmax())
    gain = np.cumsum(scores - scores[best], axis=1, dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(gain, axis=1), 0)
    stretch = max((gain[:, 1:] - low[:, :-1]).max(initial=0), gain[:, 0].max())
    if stretch <= PENALTY and max(gain.max(), 0) + max((gain[:, -1:] - gain).max(), 0) <= PENALTY:
        return np.full(scores.shape[1], best)
    rows = scores.T.tolist()
    value, tops, changes = rows[0], [], []
    for row in rows[1:]:
        top = max(value)
        least = top - PENALTY
        tops.append(value.index(top))
        changes.append([v < least for v in value])
        value = [(v if v >= least else least) + s for v, s in zip(value, row, strict=True)]
    lang = value.index(max(value))
    path = [lang]
    for top, change in zip(reversed(tops), reversed(changes), strict=True):
        if change[lang]:
            lang = top
        path.append(lang)
    return np.array(path[::-1])


class Labeller:
    """Remembers the scores of words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        # A row for each language, and one for the number of letters.
        self.known = np.empty((len(self.model.langs) + 1, 0), np.float32)

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, share of the letters, spans (start, end, language)) of each text."""
        if len(self.at) > REMEMBERED:
            self.clear()
        found = [WORD.findall(t) for t in texts]
        new = list(set().union(*found).difference(self.at))
        if new and self.model.langs:
            scores, letters = self.model.score(new)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
            self.known = np.hstack([self.known, np.vstack([scores.T, letters]).astype(np.float32)])
        look_up = self.at.__getitem__ if self.model.langs else len
        at = [np.fromiter(map(look_up, words), np.int64, len(words)) for words in found]
        return [self._label(t, own) for t, own in zip(texts, at, strict=True)]

    def _label(self, text: str, at: np.ndarray) -> tuple[str, float, list[tuple[int, int, str]]]:
        langs = self.model.langs
        known = self.known[:, at if langs else at[:0]]
        letters = known[-1].astype(np.float64)
        total = letters.sum()
        if not total:
            return "und", 0.0, []
        path = best_path(known[:-1])
        shares = np.bincount(path, letters, len(langs))
        best = int(shares.argmax())
        edges = np.flatnonzero(np.diff(path)) + 1
        if len(edges):
            starts = [m.start() for m in WORD.finditer(text)]
            cuts = [0, *(starts[e] for e in edges), len(text)]
        else:
            cuts = [0, len(text)]
        spans = [(a, b, langs[path[e]]) for a, b, e in zip(cuts, cuts[1:], [0, *edges], strict=False)]
        return langs[best], float(shares[best] / total), spans


OUT = ("lang_pred", "score", "spans")
KINDS_OUT = ("string", "double", "array<struct<start:int,end:int,lang:string>>")
_labellers: dict[str, Labeller] = {}


def _predict(batches: Iterator[pa.RecordBatch], shared, names: list[str], keep: list[str], new: list[str]) -> Iterator[pa.RecordBatch]:
    name = shared.value.name
    if name not in _labellers:
        _labellers.clear()
        _labellers[name] = Labeller(shared.value)
    own = _labellers[name]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    for batch in batches:
        for part in slices(batch, "text"):
            out = own.label([t or "" for t in part.column("text").to_pylist()])
            spans = [[{"start": a, "end": b, "lang": x} for a, b, x in row[2]] for row in out]
            arrays = [pa.array([r[0] for r in out]), pa.array([r[1] for r in out]), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays([*(part.column(names.index(n)) for n in keep), *arrays], names=[*keep, *new])


def predict(docs: DataFrame, model: Model, keep: list[str] = ("doc_id",), new: tuple[str, str, str] = OUT) -> DataFrame:
    """(columns ``keep``, lang_pred, score, spans): one row per row; learns and uses text only.

    ``lang_pred`` is the language with most letters on the best path (ties: the first by name),
    ``score`` its share of the letters, ``spans`` the stretches (start, end, lang) in characters,
    which cover the text. A null text, or one without a letter, is ``und`` with score 0 and no
    span; so is every text if nothing was learned. Repeated rows stay. No shuffle. ``new`` names the
    columns otherwise, where ``keep`` has one of that name.
    """
    keep = list(keep)
    columns = keep if "text" in keep else [*keep, "text"]
    rows = docs.select(*(F.col(f"`{n}`") for n in columns))
    fields = [f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in columns]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for n, f in zip(columns, fields, strict=True) if n in keep]
    added = [f"`{n}` {k}" for n, k in zip(new, KINDS_OUT, strict=True)]
    return rows.mapInArrow(partial(_predict, shared=shared, names=columns, keep=keep, new=list(new)), ", ".join([*kept, *added]))


def held_out() -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def label_documents(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of ``docs`` (doc_id, text, lang): learns from the
    labelled rows that aren't held out, then predicts every row. A null doc_id isn't held out."""
    model = learn(docs.where(~held_out()), sample)
    return predict(docs, model).withColumn("held_out", held_out())
