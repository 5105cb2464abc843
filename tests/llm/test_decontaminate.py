import random

import pyarrow as pa
import pytest
from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import decontaminate as C
from feeflow.llm.bytehash import text_buffer


def least_distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        now = [i]
        for j, y in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return min(before)


def _case(rnd):
    words = ["a", "b", "c", "dd", "é", "ff"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([5, 6, 9, 12, 25, 70])))) for i in range(20)]
    docs = ["", " ".join(words)]
    for _ in range(150):
        middle = rnd.choice(items)[1].split() if rnd.random() < 0.7 else []
        for _ in range(rnd.randint(0, len(middle) // 4) if middle else 0):
            middle[rnd.randrange(len(middle))] = rnd.choice(words)
        docs.append(" ".join([rnd.choice(words) for _ in range(rnd.randint(0, 30))] + middle
                             + [rnd.choice(words) for _ in range(rnd.randint(0, 30))]))
    return items, docs


def test_matches_brute_force_edit_search():
    items, docs = _case(random.Random(3))
    block = C.Block(items, 5)
    got = {(r, block.ids[n]): d for r, n, d, _, _ in C.match_block(block, *text_buffer(pa.array(docs)), 5)}
    expected = {}
    for i, text in enumerate(docs):
        for item, words in items:
            d = least_distance(words.split(), text.split())
            if d <= len(words.split()) // 5:
                expected[(i, item)] = d
    assert got == expected and len(expected) > 50


@pytest.mark.parametrize("block_items", [20_000, 2])
def test_matches_and_drop_on_odd_tables(spark, monkeypatch, block_items):
    monkeypatch.setattr(C, "BLOCK_ITEMS", block_items)
    rnd = random.Random(4)
    item = prose(rnd, 30, 5000)
    leaked = f"{prose(rnd, 50, 5000)}\n{item.upper().replace(' ', ', ', 3)}!\n{prose(rnd, 9, 5000)}"
    df = documents(spark, odd_rows(rnd) + [(50, leaked), (51, prose(rnd, 90, 5000)), (50, leaked)])
    tests = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "x"), (1, item), (None, prose(rnd, 12, 5000)),
                                   (6, prose(rnd, 8, 5000))], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.n_words) for r in C.matches(df, tests).collect())
    assert got == [(5, 4, 0, 1), *[(50, 1, 0, 30)] * 4]   # item 4 is one word: found word for word
    kept = C.drop_contaminated(df, tests)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(
        (tuple(r) for r in df.where("doc_id is null or doc_id not in (5, 50)").collect()), key=str)
    assert C.matches(documents(spark, []), tests).count() == 0
    assert C.matches(df, tests.limit(0)).count() == 0 and C.drop_contaminated(df, tests.limit(0)).count() == df.count()


def test_pieces_cover_the_item_and_exceed_the_budget():
    for n in range(5, 200):
        pieces = C.pieces_of(n)
        assert len(pieces) == n // 5 + 1 and sum(size for _, size in pieces) == n
        assert all(size > 0 for _, size in pieces)


def test_short_items_and_unspaced_scripts(spark):
    chinese = "今天天气很好我们一起去公园散步然后喝茶聊天吧朋友"   # 24 characters
    thai = "สวัสดีครับวันนี้อากาศดีมาก"
    other = "昨天下雨所以大家都留在家里看书做饭听音乐休息"
    edited = chinese[:5] + "坏" + chinese[6:15] + chinese[16:]    # one replaced, one missing
    docs = [(1, f"x y z alpha Beta, gamma delta! more"), (2, "alpha beta gamma"), (3, f"{other}。{chinese}！{other}"),
            (4, other + edited), (5, f"abc {thai} def"), (6, other), (7, "alpha beta beta gamma delta")]
    items = [(10, "alpha beta gamma delta"), (11, chinese), (12, thai), (13, "?!"), (14, "gamma")]
    found = {(r.doc_id, r.item_id): r.distance for r in C.matches(
        documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(1, 10): 0, (3, 11): 0, (4, 11): 2, (5, 12): 0, (1, 14): 0, (2, 14): 0, (7, 14): 0}
