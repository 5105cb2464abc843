"""Token encoder, packing and ORC files: exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import packing, token_orc
from feeflow.llm.catalog import tokenizer_path
from feeflow.llm.bytehash import text_buffer
from feeflow.llm.tokens import block_encoder, encoder


@pytest.fixture(scope="module")
def path():
    return tokenizer_path()


def ids_of(path, text, end):
    ids = encoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4")


def test_pieces_encode_like_whole_texts(path):
    rnd = random.Random(2)
    parts = ["a", "B", "é", ".", ",", "'s", "'t", "!", "#", "7", " ", "  ", "\n", "\n\n", "\t", "日", "\xa0", "\x1c",
             "\x85", " the", " don", "<|endoftext|>", "\0", "'", "ﬁ", "😀"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 3, 10, 40]))) for _ in range(4000)]
    e = encoder(path)
    for text, raw in zip(texts, e.encode(texts), strict=True):
        assert raw == np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_blocks_encode_like_whole_texts(path):
    rnd = random.Random(9)
    parts = ["a", "B", "é", ".", ",", "'s", "!", "7", " ", "  ", "\n", "\n\n", "\t", "日", "\xa0", "\x1c", "\x85", " the",
             " don", "<|endoftext|>", "<|endo", "ftext|>", "\0", "'", "ﬁ", "😀", "\u3000", "▁", " Ñandú,", "word" * 20]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 3, 10, 40]))) for _ in range(4000)]
    e = block_encoder(path)
    values, count = e.encode(*text_buffer(pa.array(texts)), 7)
    bounds = np.concatenate([[0], np.cumsum(count)])
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert values[a:b].tolist() == [*e.encoder.tokenizer.encode(text, add_special_tokens=False).ids, 7], repr(text)
    assert e.encode(*text_buffer(pa.array([], pa.string())), 7)[0].tolist() == []


def _rows():
    rnd = random.Random(6)
    return odd_rows(rnd) + [(100 + i, prose(rnd, rnd.randint(1, 500))) for i in range(120)]


def test_orc_round_trip_and_pruned_look_up(spark, path, scratch):
    rows = _rows()
    df = documents(spark, rows).repartition(6)
    folder = f"{scratch}/orc"
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32)
                 for r in token_orc.token_files(df, path, path=folder).collect())
    lengths = defaultdict(list)
    for doc_id, text in rows:
        a = ids_of(path, text, token_orc.END_ID)
        lengths[doc_id].append((len(a), zlib.crc32(a.tobytes())))
    at = 0
    for start, doc_id, n, crc in got:
        assert start == at and (n, crc) in lengths[doc_id]
        lengths[doc_id].remove((n, crc))
        at += n
    assert not any(lengths.values())
    order = [-1 if r[1] is None else r[1] for r in got]
    assert order == sorted(order)
    one = token_orc.read_tokens(spark, folder, [101])
    assert [list(r.ids) for r in one.collect()] == [ids_of(path, dict(rows)[101], 2).tolist()]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,101)]" in plan or "In(doc_id" in plan
    assert token_orc.token_files(documents(spark, []), path).count() == 0


def check_pieces(path, rows, pieces, window=1024):
    left = defaultdict(list)
    for doc_id, text in rows:
        left[doc_id].append(ids_of(path, text, packing.END_ID))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(left)
    for doc_id, mine in by_doc.items():
        texts = left[doc_id]
        assert sum(p.length for p in mine) == sum(map(len, texts))
        for p in mine:
            assert p.length > 0 and any(
                len(a) == p.doc_tokens and zlib.crc32(a[p.start:p.start + p.length].tobytes()) == p.ids_crc32
                for a in texts)
        if len(texts) == 1:
            at = 0
            for p in sorted(mine, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    padded = 0
    for mine in by_sequence.values():
        at = 0
        for p in sorted(mine, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded


def test_packing_is_a_partition_without_padding(spark, path):
    rows = _rows()
    df = documents(spark, rows).repartition(5)
    pieces = packing.pack(df, path).collect()
    assert check_pieces(path, rows, pieces) == 0
    for p in pieces[:200]:
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length
    assert packing.pack(documents(spark, []), path).count() == 0


def test_offsets_join_without_a_broadcast(spark, path, monkeypatch):
    monkeypatch.setattr(packing, "MAX_BROADCAST_OFFSETS", 0)
    rows = _rows()
    assert check_pieces(path, rows, packing.pack(documents(spark, rows).repartition(3), path).collect()) == 0


def test_least_squares_is_optimal_and_repeats_fit():
    rnd = np.random.default_rng(1)
    for _ in range(20):
        a, b = rnd.random((8, 14)), rnd.random(8)
        x = packing.nonnegative_least_squares(a, b)
        gradient = a.T @ (a @ x - b)
        assert (x >= 0).all() and (gradient > -1e-6).all() and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-6
    shapes = packing.combinations(16, 3)
    assert (shapes @ np.arange(1, 17) == 16).all() and len(np.unique(shapes, axis=0)) == len(shapes) == 30
    histogram = rnd.integers(0, 500, 16)
    used, repeats = packing.solve_repeats(histogram, 3)
    assert ((used * repeats[:, None]).sum(axis=0) <= histogram).all()
    even = np.zeros(16, dtype=int)
    even[[3, 11, 7]] = 10, 10, 8   # 4 + 12 and 8 + 8 fill all
    used, repeats = packing.solve_repeats(even, 3)
    assert ((used * repeats[:, None]).sum(axis=0) == even).all()
