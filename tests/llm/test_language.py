from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pytest

from gondola.llm import language


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(labelled):
    return language.learn(labelled.where(~language.held_out()))


def test_held_out_accuracy(labelled):
    rows = language.label_documents(labelled).join(labelled.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == labelled.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    for r in rows:
        assert [r.spans[0].start, *(s.end for s in r.spans)] == [*(s.start for s in r.spans), len(r.text)]
        assert 0 < r.score <= 1


def test_odd_rows(odd, empty, model):
    rows = language.predict(odd, model, odd.columns, ("__lang", "__share", "__spans")).collect()
    assert len(rows) == odd.count() and rows[0].lang_pred == "zz"
    for r in rows:
        if not any(map(str.isalpha, r.text or "")):
            assert (r["__lang"], r["__share"], r["__spans"]) == ("und", 0.0, [])
        else:
            assert r["__lang"] in model.langs
    assert language.label_documents(empty).count() == 0
    unlearned = language.label_documents(odd.where("lang is null"))
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}


def test_sample_is_bounded(labelled):
    small = language.learn(labelled, sample=100)
    assert small.langs == ["de", "en", "es", "fr"]


def test_spans_of_mixed_text(labelled, model):
    first = {lang: labelled.where(f"lang = '{lang}' and length(text) > 1500").orderBy("doc_id").first().text[:1200] for lang in ("en", "es")}
    text = first["en"] + " " + first["es"]
    (label, share, spans), = language.Labeller(model).label([text])
    assert [s[2] for s in spans] == ["en", "es"] and abs(spans[0][1] - 1200) < 60
    assert 0.4 < share < 0.6 and label in ("en", "es")


def test_best_path_is_best_of_all():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 7):
        for _ in range(60):
            scores = -rng.uniform(0, 14, (n, 3)) * rng.integers(0, 2, (n, 3))
            worth = lambda p, s=scores: sum(s[t, x] for t, x in enumerate(p)) - language.PENALTY * sum(a != b for a, b in zip(p, p[1:], strict=False))
            best = max(map(worth, product(range(3), repeat=n)))
            assert worth(language.best_path(scores.T).tolist()) == pytest.approx(best)


def test_scripts_narrow_the_candidates(spark):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("мир и слово", "ru"), ("світ і слово", "uk"), ("peace and word", "en"), ("paix et mot", "fr")] * 5)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    scores, letters = model.score(["слово", "zzz", "日本", "²"])
    ru, uk, en, fr = (model.langs.index(x) for x in ("ru", "uk", "en", "fr"))
    assert max(scores[0, en], scores[0, fr]) == -language.MOST_PER_WORD == max(scores[1, ru], scores[1, uk])
    assert letters.tolist() == [5, 3, 2, 0] and (scores[3] == 0).all()


def test_words_keep_their_marks():
    assert language.WORD.findall("हिन्दी भाषा สวัสดีครับ cafe\u0301s ❤\ufe0f x2y \u0301 a_b") == ["हिन्दी", "भाषा", "สวัสดีครับ", "cafe\u0301s", "x", "y", "a", "b"]


def test_devanagari_and_thai_are_told_apart(spark):
    """Two languages of one script by their words, one of another by its letters."""
    hindi, nepali, thai = "यह एक छोटी किताब है और वह पढ़ता है", "यो एउटा सानो किताब हो र ऊ पढ्छ", "นี่คือหนังสือเล่มเล็กและเขากำลังอ่าน"
    rows = [(k, t, lang) for k, (t, lang) in enumerate([(hindi, "hi"), (nepali, "ne"), (thai, "th")] * 20)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "वह किताब है और पढ़ता है"), (2, "ऊ किताब पढ्छ र यो सानो हो"), (3, "เขากำลังอ่านหนังสือ")], "doc_id long, text string")
    found = language.predict(asked, model, ["doc_id"], ("lang_pred", "score", "spans")).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["hi", "ne", "th"]


def test_sample_does_not_depend_on_the_layout(small, spark):
    many = small.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(10**6 + k, f"zyx wvu {k}", "zz") for k in range(3)], "doc_id long, text string, lang string"))
    models = [language.learn(docs, sample=40) for docs in (many, many.repartition(5, "text"), many.orderBy("text"))]
    assert all(m.langs == models[0].langs and (m.weights == models[0].weights).all() for m in models)
    assert "zz" in models[0].langs  # a rare language is learned too


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3 languages"):
        language.learn(spark.createDataFrame([(k, "word", str(k)) for k in range(4)], "doc_id long, text string, lang string"))
