"""Block-Max MaxScore against scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import lexical_search as L

ITEMS = "item_id long, text string"


def words(text):
    lowered = (text or "").translate(str.maketrans(L.CAPITALS, L.SMALL))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows, items, k=10):
    """(item_id, text) -> [(rank, score)] and all admissible (doc_id, score)."""
    docs = [(i, Counter(words(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in docs)
    n_terms = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = {}
    for item_id, text in items:
        scored = []
        for doc_id, c in docs:
            m = 25 + 75 * sum(c.values()) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out[item_id, text] = [(r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return out


def check(found, rows, items, k=10):
    want = sorted(((i, *r) for (i, _), rs in brute(rows, set(items), k).items() for r in rs), key=str)
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str)
    assert got == want


def _rows(n=400):
    rnd = random.Random(3)
    common = ["the", "of", "und", "É", "a1"]
    rows = odd_rows(rnd)
    for i in range(n):
        text = [rnd.choice(common) if rnd.random() < 0.5 else f"w{int(rnd.paretovariate(0.6)) % 3000}"
                for _ in range(rnd.randint(0, 120))]
        rows.append((100 + i, rnd.choice([" ", ", ", "\n"]).join(text)))
    return rows + [(900 + i, "The twin of texts, w7") for i in range(30)]   # ties


def _items(rows):
    rnd = random.Random(4)
    items = [(i, (rows[rnd.randrange(len(rows))][1] or "")[:rnd.randint(5, 400)]) for i in range(40)]
    return items + [(0, items[0][1]), (0, "another TEXT of the item w3"), (None, "w1 w2 the"), (77, None), (78, ""),
                    (79, "nowhere-at-all"), (80, "the the of w5 w5 w5"), (81, "THE twin of texts")]


def test_search_equals_brute_force(spark):
    rows, items = _rows(), _items(_rows())
    docs = documents(spark, rows).repartition(4)
    asked = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS rank", "'y' AS score", "'z' AS term")
    check(L.ranked_search(docs, asked), rows, items)
    # more shards than partitions, items in several blocks, another k
    size = L.collection_size(docs)
    index = L.build_index(docs, size, shard_bytes=4000)
    assert index.where("term is null").count() > 8
    check(L.search(index, asked, size[0], k=3, items_a_task=7), rows, items, 3)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    for rows in ([], [(1, None), (2, "- - -")]):
        assert L.ranked_search(documents(spark, rows), items).count() == 0
    assert L.ranked_search(documents(spark, [(1, "a b")]), items.limit(0)).count() == 0


def test_index_holds_every_term_of_every_row(spark):
    rows = _rows(60)
    size = L.collection_size(documents(spark, rows))
    counted = [Counter(words(t)) for _, t in rows]
    assert size == (sum(bool(c) for c in counted), sum(sum(c.values()) for c in counted))
    index = L.build_index(documents(spark, rows).repartition(2), size)
    df = {r.term: r.n for r in index.where("term is not null").groupBy("term").sum("n").toDF("term", "n").collect()}
    assert df == Counter(t for c in counted for t in c)


def _lists(rnd, n_docs, terms):
    m = rnd.integers(25, 400, n_docs)
    out, dense = [], np.zeros(n_docs, dtype=np.int64)
    for share_of_docs, weight in terms:
        docs = np.flatnonzero(rnd.random(n_docs) < share_of_docs)
        if not len(docs):
            continue
        tf = rnd.integers(1, rnd.choice([2, 40, 300, 70_000]), len(docs))
        heads, data, n, top = L.posting_lists(docs, tf, np.array([0]), m)
        out.append((weight, L.PostingList(int(n[0]), int(top[0]), heads[0].as_py(), data[0].as_py(), m)))
        dense[docs] += weight * L.share(tf, m[docs])
    return out, dense


@pytest.mark.parametrize("seed", range(6))
def test_postings_round_trip_and_top_documents(seed):
    rnd = np.random.default_rng(seed)
    n_docs = int(rnd.integers(1, 9000))
    terms = [(rnd.random() ** 4, int(rnd.integers(0, 8000))) for _ in range(12)]
    lists, dense = _lists(rnd, n_docs, terms)
    order = rnd.permutation(n_docs)
    docs, scores = L.top_documents(lists, n_docs, order, 10, window=int(rnd.choice([7, 300, 1024])))
    want = np.lexsort((order, -dense))[:10]
    want = want[dense[want] > 0]
    got = np.lexsort((order[docs], -scores))
    assert docs[got].tolist() == want.tolist() and scores[got].tolist() == dense[want].tolist()


def test_block_maxima_spare_blocks():
    rnd = np.random.default_rng(1)
    n_docs = 60_000
    m = np.full(n_docs, 100)
    frequent = np.arange(n_docs)
    tf = np.ones(n_docs, dtype=np.int64)
    rare = np.sort(rnd.choice(n_docs, 60, replace=False))
    lists = []
    for docs, freq, weight in ((frequent, tf, 20), (rare, np.full(60, 5), 6000)):
        heads, data, n, top = L.posting_lists(docs, freq, np.array([0]), m)
        lists.append((weight, L.PostingList(int(n[0]), int(top[0]), heads[0].as_py(), data[0].as_py(), m)))
    docs, _ = L.top_documents(lists, n_docs, np.arange(n_docs), 10)
    assert set(docs) == set(rare[:10])
    opened, blocks = len(lists[0][1].known), len(lists[0][1].first)
    assert opened < blocks / 3   # the frequent list's blocks stay packed but for candidates
