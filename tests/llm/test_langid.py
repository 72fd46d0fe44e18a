import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import langid
from tidewatch.llm.common import id_fold

from .helpers import ODD, documents


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = id_fold(F.col("doc_id"), 4) == 2
    found = langid.predict(docs.where(held_out), langid.fit(docs.where(~held_out))).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_ngram_vector_binds_rotated_letters():
    s = langid.symbols_of("ab")
    assert s.tolist() == [0, 1, 2, 0]
    letters = np.random.default_rng(5).choice(np.array([-1, 1], np.int8), (langid.SYMBOLS, 64))
    gram = (1 * langid.SYMBOLS + 2) * langid.SYMBOLS + 0
    expected = np.roll(letters[1], 2) * np.roll(letters[2], 1) * letters[0]
    assert (langid.ngram_vectors(np.array([gram]), 3, 64, 5)[0] == expected).all()


def test_cosine_against_the_definition():
    texts = {"x": "abab abba baab", "y": "cdcd dccd ccdd"}
    dense = {k: np.zeros(langid.SYMBOLS ** 3, np.int64) for k in texts}
    for k, t in texts.items():
        grams, n = langid.ngram_counts(t)
        dense[k][grams] = n
    p = langid.Profiles(dense, 3, 256, 1)

    def vector(t):
        s = langid.symbols_of(t)
        grams = [(s[i] * langid.SYMBOLS + s[i + 1]) * langid.SYMBOLS + s[i + 2] for i in range(len(s) - 2)]
        return langid.ngram_vectors(np.array(grams), 3, 256, 1).astype(float).sum(axis=0)
    q = vector("abba cd")
    want = [q @ vector(t) / np.linalg.norm(q) / np.linalg.norm(vector(t)) for t in texts.values()]
    assert np.allclose(p.cosines([langid.ngram_counts(t) for t in ("aab", "abba cd")])[1], want, atol=1e-5)


def test_odd_rows(spark):
    train = documents(spark, [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "unknown", None), (4, None, "de")])
    profiles = langid.fit(train)
    assert profiles.languages == ["en", "fr"]
    found = {}
    for r in langid.predict(documents(spark, ODD, extra=True), profiles).collect():
        found.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for k in (1, 2, 3, 7):
        assert found[k] == [("und", 0.0)]
    assert len(found[5]) == 2 and found[5][0] == found[5][1] == found[4][0]
    assert all(v[0][0] in ("en", "fr") for k, v in found.items() if k not in (1, 2, 3, 7))
    kept = langid.keep_identified(documents(spark, ODD), profiles)
    assert kept.count() == len(ODD) - 4 and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_tables(spark):
    none = langid.fit(documents(spark, []))
    assert [r.lang_pred for r in langid.predict(documents(spark, [(1, "text")]), none).collect()] == ["und"]
    assert langid.predict(documents(spark, []), none).collect() == []


def test_an_input_without_languages_keeps_its_documents(spark):
    rows = documents(spark, [(1, "the cat", None), (2, "le chat", None), (3, "12 34 !!", None), (4, None, None)])
    profiles = langid.fit(rows)
    assert not profiles.languages
    assert sorted(r.doc_id for r in langid.keep_identified(rows, profiles).collect()) == [1, 2]
