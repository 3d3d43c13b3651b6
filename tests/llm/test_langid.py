import random

import numpy as np
import pytest
from cases import as_docs

from cartwheel.llm import langid, queries
from cartwheel.llm.langid import CHUNK, BINS, accepted, clusters, fit, gram_counts, identify


@pytest.fixture(scope="module")
def model(small_docs):
    return fit(small_docs.filter(~queries.held_out(small_docs)))


def test_held_out_accuracy(small_docs, model):
    rows = identify(small_docs.filter(queries.held_out(small_docs)), model).join(small_docs, "doc_id").collect()
    assert len(rows) > 20
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_clean_documents_are_accepted(small_docs, model):
    assert accepted(small_docs, model).count() == small_docs.count()


def test_awkward_texts(spark, model):
    texts = {1: None, 2: "", 3: " 12 ... \n", 4: "É", 5: "the of and " * 300_000, 6: "日本語", 7: "qqxzqj zzxqq jjqxz " * 5}
    docs = as_docs(spark, [(i, t, "xx", None) for i, t in texts.items()] + [(None, "the thing of that", None, None), (1, None, "en", "s")])
    rows = {r.doc_id: r for r in identify(docs, model).collect()}
    assert len(identify(docs, model).collect()) == 9
    for i in (1, 2, 3):
        assert (rows[i].lang_pred, rows[i].score, rows[i].rejected) == ("und", 0.0, True)
    assert rows[5].lang_pred == "en" and rows[None].lang_pred == "en"
    assert all(rows[i].lang_pred in set(model.languages) for i in (4, 5, 6, 7, None))
    # no language's n-grams: too far from every centroid
    assert rows[6].rejected and rows[7].rejected and not rows[5].rejected
    assert accepted(docs, model).columns == docs.columns
    assert {r.doc_id for r in accepted(docs, model).collect()} >= {5, None}


def test_nothing_to_learn_from(spark, no_docs):
    model = fit(no_docs)
    assert identify(no_docs, model).collect() == []
    rows = identify(as_docs(spark, [(1, "some text", "en", "s")]), model).collect()
    assert [(r.lang_pred, r.rejected) for r in rows] == [("und", True)]


def test_prediction_does_not_look_at_the_other_columns(spark, small_docs, model):
    plain = {r.doc_id: (r.lang_pred, r.score) for r in identify(small_docs, model).collect()}
    other = small_docs.selectExpr("-doc_id as doc_id", "text", "'fr' as lang", "'x' as source")
    assert {-r.doc_id: (r.lang_pred, r.score) for r in identify(other, model).collect()} == plain


def test_the_sample_is_bounded_and_even(small_docs):
    sample = langid.training_sample(small_docs, "doc_id", "text", "lang", rows=40).collect()
    assert 0 < len(sample) <= 80


def test_chunks_count_every_gram_once(monkeypatch):
    text = "ab cd efg " * 40
    whole = gram_counts(text)
    for chunk in (1, 2, 3, 7, 399, 400, 401):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert np.array_equal(gram_counts(text), whole)
    assert whole.shape == (BINS,) and CHUNK > 401


def test_several_centroids():
    rng = np.random.default_rng(0)
    points = np.concatenate([np.eye(8)[k] + rng.normal(0, 0.02, (20, 8)) for k in range(3)])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    means, label = clusters(points, 3)
    assert len(means) == 3 and [len(set(label[20 * k : 20 * k + 20])) for k in range(3)] == [1, 1, 1]


def test_long_junk_and_unlearned_scripts_are_rejected_and_short_clean_texts_are_not(small_docs, model):
    rng = random.Random(5)
    junk = lambda letters, n, longest: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n))
    latin, consonants = "abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"
    chinese, cyrillic, greek = ("".join(map(chr, range(*r))) for r in ((0x4E00, 0x9FA5), (0x430, 0x450), (0x3B1, 0x3CA)))
    texts = [junk(letters, n, 9) for letters in (latin, consonants, chinese, cyrillic, greek) for n in (20, 100, 1_000, 10_000)]
    assert all(model.predict(texts)[2])
    short = [" ".join(r.text.split()[5 : 5 + n]) for r in small_docs.collect() for n in (6, 12, 25) if len(r.text.split()) >= 5 + n]
    assert len(short) > 300 and not any(model.predict(short)[2])


def test_every_label_is_learned(spark):
    """300 labels, each with words of its own; a sample of fewer rows than labels."""
    word = lambda k, n: "".join(chr(97 + (k * 7 + n * d) % 26) for d in range(1, 8))
    rows = [(k * 10 + n, " ".join(word(k, j + n) for j in range(12)), f"l{k:03d}", "s") for k in range(300) for n in range(4)]
    model = fit(as_docs(spark, rows), rows=100)
    assert set(model.languages) == {f"l{k:03d}" for k in range(300)}


@pytest.mark.parametrize("i", [7, None])
def test_rows_that_repeat_one_id_are_learned_from(spark, i):
    docs = as_docs(spark, [(i, f"the word number {k} of the text", "en", "s") for k in range(3_000)] + [(i, "das Wort", "de", "s")] * 500)
    sample = langid.training_sample(docs, "doc_id", "text", "lang", rows=200).collect()
    assert {r.lang for r in sample} == {"en", "de"} and len(sample) <= 400
    assert set(fit(docs).languages) == {"en", "de"}


def test_numerals_are_no_letters(model):
    langs, scores, rejected = model.predict(["½ ²", "Ⅷ", "①②③", "12_3", "ª", "x"])
    assert langs[:4] == ["und"] * 4 and not scores[:4].any() and rejected[:4].all()
    assert "und" not in langs[4:]


def test_cosines_and_rejection_by_dense_vectors(small_docs, model):
    """Dense TF-IDF vectors and all centroids compared one by one."""
    texts = [r.text for r in small_docs.limit(40).collect() if langid.has_letter(r.text)] + ["x y z", "qqxzqj zzxqq", "日本語"]
    dense = np.zeros((len(model.centroids), BINS))
    for row, (at, values) in zip(dense, model.centroids):
        row[at] = values
    langs, scores, rejected = model.predict(texts)
    for text, lang, score, out in zip(texts, langs, scores, rejected):
        counts = gram_counts(text).astype(float)
        v = np.where(counts > 0, np.log1p(counts) * model.idf, 0.0)
        cosines = dense @ (v / np.linalg.norm(v))
        best, n = int(cosines.argmax()), int((counts > 0).sum())
        assert lang == model.languages[best] and abs(score - cosines[best]) < 1e-5
        reach = np.linalg.norm(np.sort(dense[best])[::-1][:n])
        assert out == (cosines[best] < model.shares[best, int(np.log2(n))] * reach)


def test_own_columns_of_the_operators_names_stay(spark, model):
    docs = as_docs(spark, [(1, "the thing of that", "en", "s")]).selectExpr("*", "5 AS _lid", "6 AS _LID_")
    kept = accepted(docs, model)
    assert kept.columns == docs.columns and [(r._lid, r._LID_) for r in kept.collect()] == [(5, 6)]
