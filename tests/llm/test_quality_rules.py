import random
import re
from collections import Counter

import pyarrow as pa
from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import quality_rules as Q
from feeflow.llm.bytehash import text_buffer


def brute(text, least=Q.MIN_REPEAT):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)

    def covered(k):
        count = Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        return len({p for i in range(len(words) - k + 1) if count[tuple(words[i:i + k])] > 1
                    for p in range(i, i + k)})

    longest, k = 0, least
    while k <= len(words) and covered(k):
        longest, k = k, k + 1
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, covered(5),
            covered(least), longest)


def test_counts_match_brute_force():
    rnd = random.Random(1)
    texts = [None, "", "a", "\n", "\n\n a", "a\n", "a\na\n a \na", "x " * 50, "x y " * 40]
    texts += ["".join(rnd.choice(["a", "é", "b", "#", "xy", "日"]) + rnd.choice([" ", "\n", "\t", "  ", "\x85"])
                      for _ in range(rnd.choice([1, 5, 20, 60]))) for _ in range(200)]
    found = Q.measure(*text_buffer(pa.array(texts)))
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in Q.COUNTS) == brute(text), (i, text)


def test_verdicts_and_odd_rows(spark):
    rnd = random.Random(2)
    good, part = prose(rnd, 200, 5000), prose(rnd, 30, 5000)
    rows = odd_rows(rnd) + [(20, good), (21, (part + " ") * 5), (22, "a b c"),
                            (23, prose(rnd, 400, 9000) + " " + (long := prose(rnd, 110, 9000)) + " "
                             + prose(rnd, 900, 9000) + " " + long)]
    got = {r.doc_id: r for r in Q.quality_rules(documents(spark, rows)).collect()}
    assert len(Q.quality_rules(documents(spark, rows)).collect()) == len(rows)
    assert got[20].kept and not got[20].base_failed
    assert got[21].base_failed and got[22].base_failed and not got[21].kept
    assert not got[23].base_failed and got[23].longest_repeat == 110 and not got[23].kept
    assert got[1].n_words == 0 and got[1].base_failed and got[2].base_failed
    assert got[6].n_words == 20_000


def test_kept_rows_are_unchanged(spark):
    rnd = random.Random(3)
    df = documents(spark, odd_rows(rnd) + [(20, prose(rnd, 200, 5000))])
    kept = Q.keep_good(df)
    assert kept.columns == df.columns
    rows = {tuple(r) for r in df.collect()}
    assert {tuple(r) for r in kept.collect()} <= rows and 20 in {r.doc_id for r in kept.collect()}
    assert Q.keep_good(documents(spark, [])).count() == 0
