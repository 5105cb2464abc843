import random
from itertools import combinations

import numpy as np
import pyarrow as pa
from llm_fixtures import documents, odd_rows

from feeflow.llm import quality_fm as M
from feeflow.llm.bytehash import text_buffer

SF = "/root/testdata/sf0.01"


def _machine(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, M.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy_and_inputs(spark):
    docs, machine = _machine(spark)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = M.score(docs, machine).collect()
    assert len(rows) == docs.count()
    test = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in test)
    assert right / len(test) >= 0.95
    good = [r.score for r in test if labels[r.doc_id]]
    bad = [r.score for r in test if not labels[r.doc_id]]
    assert np.mean([[g > b for g in good] for b in bad]) >= 0.98
    # language, source and id are no inputs of a score
    swapped = docs.selectExpr("doc_id + 1000000 AS doc_id", "text", "'zz' AS lang", "'other' AS source", "n_chars")
    assert sorted(r.score for r in M.score(swapped, machine).collect()) == sorted(r.score for r in rows)


def test_linear_time_identity_equals_the_sum_over_pairs():
    rnd = np.random.default_rng(3)
    size, width = (1 << M.WORD_BITS) + 3, 3
    machine = M.Machine(0.3, rnd.normal(size=size), rnd.normal(size=(size, 4)), np.zeros(width), np.ones(width))
    bounds, words = np.array([0, 4, 4, 9]), rnd.choice(1 << M.WORD_BITS, 9, replace=False)
    dense = rnd.normal(size=(3, width))
    raw = machine.parts(bounds, words, dense)[0]
    for i in range(3):
        own = words[bounds[i]:bounds[i + 1]]
        x = {int(w): 1 / np.sqrt(max(len(own), 1)) for w in own}
        x |= {(1 << M.WORD_BITS) + j: dense[i, j] for j in range(width)}
        pairs = sum(machine.factor[a] @ machine.factor[b] * x[a] * x[b] for a, b in combinations(x, 2))
        assert np.isclose(raw[i], 0.3 + sum(machine.weight[k] * v for k, v in x.items()) + pairs)


def test_odd_rows_and_empty_tables(spark):
    _, machine = _machine(spark)
    rows = odd_rows(random.Random(1))
    got = M.score(documents(spark, rows), machine).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert M.score(documents(spark, []), machine).count() == 0
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    assert M.score(documents(spark, rows), M.train(documents(spark, rows), labels)).count() == len(rows)
    none = M.train(documents(spark, []), labels.limit(0))
    assert {r.score for r in M.score(documents(spark, [(1, "a b c")]), none).collect()} != set()


def test_features_of_one_text_do_not_depend_on_its_neighbours():
    texts = ["one two two\nthree", "", "X! Y! X!", "one two two\nthree"]
    n = np.array([len(t) for t in texts], dtype=float)
    bounds, words, statistics = M.features(*text_buffer(pa.array(texts)), n)
    alone = M.features(*text_buffer(pa.array(texts[3:])), n[3:])
    assert words[bounds[3]:bounds[4]].tolist() == alone[1].tolist()
    assert np.allclose(statistics[3], alone[2][0]) and np.allclose(statistics[0], statistics[3])


def test_gradients_equal_finite_differences(monkeypatch):
    """One step from zero learning memory moves along the gradient."""
    rnd = np.random.default_rng(5)
    size, width, rank = (1 << M.WORD_BITS) + 2, 2, 3
    bounds, words = np.array([0, 3, 3, 7]), rnd.choice(1 << M.WORD_BITS, 7, replace=False)
    labels, statistics = np.array([1.0, 0.0, 1.0]), rnd.normal(size=(3, width))
    monkeypatch.setattr(M, "PENALTY", 0.0)
    monkeypatch.setattr(M, "RATE", 1e-6)
    before = M.fit(bounds, words, statistics, labels, rank=rank, epochs=0)
    after = M.fit(bounds, words, statistics, labels, rank=rank, epochs=1)

    def loss(machine):
        p = machine.score(bounds, words, statistics)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for part in ("weight", "factor"):
        moved = getattr(after, part) - getattr(before, part)
        for at in [tuple(x) for x in np.argwhere(np.abs(moved) > 0)[:: 3]]:
            array = getattr(before, part)
            old, h = array[at], 1e-5
            array[at] = old + h
            up = loss(before)
            array[at] = old - h
            down = loss(before)
            array[at] = old
            slope = (up - down) / (2 * h)
            # Adagrad: step = -rate * slope / sqrt(0.01 + slope^2)
            assert np.isclose(moved[at], -1e-6 * slope / np.sqrt(0.01 + slope ** 2), rtol=1e-2, atol=1e-12)


def test_repeated_ids_are_fitted_alike(spark):
    rows = [(i % 5, f"text {i} " * (i + 1)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    machines = [M.train(documents(spark, rows, clashing=False).repartition(n), labels) for n in (1, 7)]
    assert np.array_equal(machines[0].weight, machines[1].weight)
