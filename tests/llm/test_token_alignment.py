"""Cross-tokenizer alignment against token by token brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import token_alignment as A
from feeflow.llm.bytehash import text_buffer
from feeflow.llm.catalog import op13_token_alignment, piece_model_path, tokenizer_path

PARTS = ["a", "B", "é", ".", ",", "'s", "!", "#", "7", " ", "  ", "\n", "\n\n", "\t", "日", "\xa0", "\x85", " the", "　",
         " don", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\0", "▁", "ﬁ", "😀", " ciónmi", "Ñandú", "\r\n"]


@pytest.fixture(scope="module")
def paths():
    return tokenizer_path(), piece_model_path()


def encoders(paths):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=paths[1])


def brute(paths, rows):
    """Per row: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha, n_overlaps)."""
    tok, sp = encoders(paths)
    byte = {c: b for b, c in A.Encoder.alphabet.items()}
    docs, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, bytes(byte[c] for c in tok.id_to_token(i)))
             for i in tok.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
              else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text or "")]
        if not text or any(b"".join(t for _, t in x) != whole for x in (a, b)):
            docs.append((doc_id, [], [], []))
            continue
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, t in side:
                found.append((at, at + len(t), i))
                at += len(t)
            spans.append(found)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[1] == y[1]] if len(whole) < 3000 else None
        if links is None:
            ends = {y[1]: y[2] for y in spans[1]}
            links = [(x[2], ends[x[1]]) for x in spans[0] if x[1] in ends]
        counts.update(links)
        docs.append((doc_id, *spans, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, a, b, links in docs:
        common = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, low = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= end) for side in (a, b))
                          if len(a) < 2000 else "?")
            low = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        overlaps = len(a) + len(b) - len({x[0] for x in a} & {y[0] for y in b})
        out.append((doc_id, len(a), len(b), len(common), len(links),
                    sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    sha if "?" not in groups else None, overlaps))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]


def _rows():
    rnd = random.Random(6)
    odd = ["".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 1, 3, 10, 40]))) for _ in range(1500)]
    return odd_rows(rnd) + [(100 + i, prose(rnd, rnd.randint(1, 200))) for i in range(40)] \
        + [(1000 + i, t) for i, t in enumerate(odd)]


def check(df, rows, paths):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)
    want = sorted(brute(paths, rows), key=lambda r: str(r[:7] + ((r[7],) if r[7] is not None else ("?",)) + r[8:]))
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1:7], r[8])
    shas = {key(r): r[7] for r in want}
    assert sorted(map(key, got)) == sorted(map(key, want))
    for r in got:
        assert shas[key(r)] in (None, r[7]), r


def test_rows_equal_brute_force(spark, paths):
    rows = _rows()
    check(A.alignment(documents(spark, rows).repartition(5), *paths), rows, paths)
    assert A.alignment(documents(spark, []), *paths).count() == 0


@pytest.mark.parametrize("most", [0, 40])
def test_pairs_beyond_the_broadcast_are_joined(spark, paths, most):
    rows = _rows()[:400]
    check(A.alignment(documents(spark, rows).repartition(3), *paths, most_broadcast=most), rows, paths)


def test_pieces_encode_like_whole_texts(paths):
    import pyarrow as pa

    rnd = random.Random(2)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 1, 3, 10, 60]))) for _ in range(4000)]
    tok, sp = encoders(paths)
    both = A.sides(*paths)
    found = A.tokenised(*text_buffer(pa.array(texts)), both)
    byte_a, byte_b = (s.length for s in both)
    at = [np.concatenate([[0], np.cumsum(c)]) for _, c in found]
    kept = 0
    for i, text in enumerate(texts):
        a, b = (ids[at[k][i]:at[k][i + 1]].tolist() for k, (ids, _) in enumerate(found))
        want_a = tok.encode(" " + text, add_special_tokens=False).ids
        want_b = sp.encode(text)
        same = text and byte_a[want_a].sum() == byte_b[want_b].sum() == len((" " + text).encode()) and "▁" not in text
        assert (a, b) == ((want_a, want_b) if same else ([], [])), repr(text)
        kept += bool(same)
    assert kept > 1500


def test_the_query_reads_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(op13_token_alignment(spark, sf), docs, (tokenizer_path(), piece_model_path()))
