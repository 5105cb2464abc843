"""The random field against sums over all labellings; held-out accuracy."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents, odd_rows

from feeflow.llm import language_crf as C
from feeflow.llm.bytehash import text_buffer
from feeflow.llm.catalog import op11_crf_language_id

SF = "/root/testdata/sf0.01"


def all_labellings(scores, transition):
    """log Z and the posterior of every word, by enumeration of one chain."""
    n, k = scores.shape
    total, each = 0.0, np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        p = np.exp(sum(scores[t, c] for t, c in enumerate(y)) + sum(transition[a, b] for a, b in zip(y, y[1:])))
        total += p
        for t, c in enumerate(y):
            each[t, c] += p
    return np.log(total), each / total


def test_forward_backward_equals_enumeration():
    rnd = np.random.default_rng(1)
    lengths = [0, 1, 5, 0, 7, 2, 1]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    scores, transition = rnd.normal(0, 2, (bounds[-1], 3)), rnd.normal(0, 1, (3, 3))
    posterior = C.forward_backward(scores, transition, bounds)[0]
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            assert np.allclose(posterior[a:b], all_labellings(scores[a:b], transition)[1])


def test_long_chains_in_pieces_equal_a_plain_loop(monkeypatch):
    rnd = np.random.default_rng(2)
    bounds = np.array([0, 700, 701, 705, 2000])
    scores, transition = rnd.normal(0, 3, (2000, 4)), rnd.normal(0, 2, (4, 4))
    whole = np.zeros_like(scores)
    for a, b in zip(bounds[:-1], bounds[1:]):
        f, g, m = [], [np.ones(4)], np.exp(transition)
        for t in range(a, b):
            x = np.exp(scores[t]) * (f[-1] @ m if f else np.ones(4))
            f.append(x / x.sum())
        for t in range(b - 1, a, -1):
            x = m @ (np.exp(scores[t]) * g[-1])
            g.append(x / x.sum())
        p = np.array(f) * np.array(g[::-1])
        whole[a:b] = p / p.sum(axis=1, keepdims=True)
    for width in (2, 64, 5000):
        monkeypatch.setattr(C, "CHAIN", width)
        assert np.allclose(C.forward_backward(scores, transition, bounds)[0], whole, atol=1e-6)


def test_gradient_equals_finite_differences():
    rnd = np.random.default_rng(3)
    words = C.words_of(*text_buffer(pa.array(["the der und", "Éa the", "la"])))
    k, labels = 3, rnd.integers(0, 3, len(words))
    bounds = np.searchsorted(words.row, np.arange(4))
    names = np.unique(words.name)
    model = C.Field(["a", "b", "c"], names[:2], np.array([0, 2]))
    model.weight = rnd.normal(0, 0.5, model.weight.shape)
    model.listed, model.transition = rnd.normal(size=model.listed.shape), rnd.normal(size=(k, k))

    def log_likelihood():
        scores, total = model.scores(words), 0.0
        for a, b in zip(bounds[:-1], bounds[1:]):
            y = labels[a:b]
            total += sum(scores[a + t, c] for t, c in enumerate(y)) - all_labellings(scores[a:b], model.transition)[0]
            total += sum(model.transition[i, j] for i, j in zip(y, y[1:]))
        return total

    slopes = C.gradient(model, words, labels, bounds)
    used = np.unique(np.concatenate([words.affix.reshape(-1), words.gram]))
    cells = [(model.weight, slopes[0], (c, f)) for c in range(k) for f in used[::5]]
    cells += [(p, s, i) for p, s in ((model.listed, slopes[1]), (model.transition, slopes[2]))
              for i in np.ndindex(p.shape)]
    for part, slope, at in cells:
        old = part[at]
        part[at] = old + 1e-4
        up = log_likelihood()
        part[at] = old - 1e-4
        down = log_likelihood()
        part[at] = old
        assert np.isclose((up - down) / 2e-4, slope[at], atol=1e-4), at
    assert not slopes[0][:, np.setdiff1d(np.arange(1 << C.FEATURE_BITS), used)].any()


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, C.train(docs)


def test_held_out_accuracy_and_inputs(spark, fitted):
    docs, model = fitted
    rows = C.detect(docs, model).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang)
    test = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in test]) >= 0.98 and len(test) > 200
    assert all(0 <= r.score <= 1 for r in rows)
    # language, source and id are no inputs of a prediction
    swapped = docs.selectExpr("doc_id + 7000000 AS doc_id", "text", "'zz' AS lang", "'other' AS source", "n_chars")
    assert sorted(r.score for r in C.detect(swapped, model).collect()) == sorted(r.score for r in rows)


def test_held_out_labels_are_not_learned(spark, fitted):
    docs, _ = fitted
    wrong = docs.withColumn("lang", C.F.when(C.held_out(), "zz").otherwise(C.F.col("lang")))
    a, b = C.training_rows(docs, 300), C.training_rows(wrong, 300)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 300


def test_code_switched_words(spark, fitted):
    docs, model = fitted
    rnd = random.Random(5)
    by_lang = {}
    for r in docs.where(C.held_out()).select("lang", "text").collect():
        clean = [w for w in (r.text or "").split() if w.strip(",.").isalpha()]
        by_lang.setdefault(r.lang, []).extend(clean)
    rows, truth = [], {}
    for i in range(60):
        parts, labels = [], []
        for _ in range(5):
            lang = rnd.choice(sorted(by_lang))
            at, n = rnd.randrange(len(by_lang[lang]) - 60), rnd.randint(8, 50)
            parts += by_lang[lang][at:at + n]
            labels += [lang] * n
        rows.append((i, " ".join(parts)))
        truth[i] = labels
    right = total = 0
    for r in C.language_spans(documents(spark, rows), model).collect():
        found = [s.lang for s in r.spans for _ in range(s.n_words)]
        assert [s.first_word for s in r.spans] == np.cumsum([0, *(s.n_words for s in r.spans)])[:-1].tolist()
        assert len(found) == len(truth[r.doc_id])
        right += sum(a == b for a, b in zip(found, truth[r.doc_id]))
        total += len(found)
    assert right / total >= 0.95


def test_odd_rows_ties_and_empty_tables(spark, fitted):
    rnd = random.Random(1)
    rows = odd_rows(rnd) + [(20, "12 !! 😀 —"), (21, "12 a"), (22, "日本")]
    docs = documents(spark, rows)
    got = C.detect(docs, fitted[1]).collect()
    assert len(got) == len(rows)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {1, 2, 3, 20, None} or und == {1, 2, 3, 20}
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and all(0 <= r.score <= 1 for r in got)
    assert C.detect(documents(spark, []), fitted[1]).count() == 0
    own = C.identify(docs).collect()
    assert len(own) == len(rows) and {r.lang_pred for r in own} <= {"en", "und"}
    none = C.train(documents(spark, []))
    assert {(r.lang_pred, r.score) for r in C.detect(docs, none).collect()} == {("und", 0.0)}
    assert all(r.spans == [] for r in C.language_spans(docs, none).collect())
    # equal masses: the alphabetically first
    flat = C.Field(["aa", "bb"])
    assert {r.lang_pred for r in C.detect(docs, flat).collect()} == {"aa", "und"}


def test_features_of_one_text_do_not_depend_on_its_neighbours():
    texts = ["Über éa", "", "x", "ÜBER ÉA"]
    words = C.words_of(*text_buffer(pa.array(texts)))
    alone = C.words_of(*text_buffer(pa.array(texts[3:])))
    own = words.row == 3
    assert np.array_equal(words.affix[:, own], alone.affix) and np.array_equal(words.name[own], alone.name)
    assert np.array_equal(words.affix[:, words.row == 0], alone.affix)   # capitals fold
    assert np.array_equal(words.take(np.flatnonzero(own)).gram, alone.gram)


def test_the_query_labels_every_document(spark):
    sf = "/root/testdata/sf0.001"
    rows = op11_crf_language_id(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(lang) and len(rows) == len(lang)
    test = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and lang[r.doc_id]]
    assert np.mean(test) >= 0.95
