import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import suffix_dedup as D


def brute(rows, threshold):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(b[i:i + threshold] for _, b in texts for i in range(len(b) - threshold + 1))
    out = []
    for doc_id, b in texts:
        covered = bytearray(len(b))
        for i in range(len(b) - threshold + 1):
            if seen[b[i:i + threshold]] > 1:
                covered[i:i + threshold] = b"\1" * threshold
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = [i for i in range(len(b)) if covered[i] and (i == 0 or not covered[i - 1])]
        out.append((doc_id, len(b), sum(covered), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, threshold):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
                   for r in D.remove_repeats(df, threshold, 16).collect()), key=str)


def _mixed(rnd):
    passage, other = prose(rnd, 40), prose(rnd, 15)
    rows = [(i, " ".join([prose(rnd, rnd.randrange(20)), passage if i % 3 else other,
                          prose(rnd, rnd.randrange(20)), other if i % 2 else ""])) for i in range(40)]
    rows += [(100 + i, passage.replace("w1", "v1", i % 4)) for i in range(30)]  # near copies
    return rows + odd_rows(rnd)


@pytest.mark.parametrize("threshold", [60, 200])
def test_matches_brute_force(spark, threshold):
    rows = _mixed(random.Random(threshold))
    assert found(documents(spark, rows).repartition(5), threshold) == brute(rows, threshold)


def test_periodic_and_overlapping_repeats(spark):
    rows = [(1, "ab" * 150), (2, "x" * 61), (3, "x" * 60), (4, "abc" * 40 + "q" + "abc" * 40), (5, "x" * 59)]
    assert found(documents(spark, rows), 60) == brute(rows, 60)


def test_empty_table(spark):
    assert found(documents(spark, []), 60) == []


def test_runs_hold_every_position_once_in_any_segmenting(monkeypatch):
    rnd = random.Random(1)
    column = pa.array([prose(rnd, 300), None, "short", prose(rnd, 50), "y" * 700])
    whole = {}
    for size in (1 << 20, 257):
        monkeypatch.setattr(D, "SEGMENT", size)
        places = Counter()
        for row, low, n, _, _, _ in D.batch_runs(column, 60, 16):
            for r, a, k in zip(row.tolist(), low.tolist(), n.tolist(), strict=True):
                places.update((r, p) for p in range(a, a + k))
        whole[size] = places
    assert whole[257] == whole[1 << 20] and set(whole[257].values()) == {1}
    expected = {(r, p) for r, t in enumerate(column.to_pylist()) for p in range(len(t or "") - 59)}
    assert set(whole[257]) == expected
