import random

from llm_fixtures import documents, odd_rows, prose

from feeflow.llm import licenses, line_spread, sharding


def _spread_rows(rnd, sites):
    rows = []
    for i in range(60):
        lines = [prose(rnd, 5, 10_000)]
        if i < sites:
            lines.append("common line ")
        if i < sites - 1:
            lines.append("rare line")
        rows.append((i, "\n".join(lines), "en", f"s{i}"))
    return rows


def test_lines_at_the_threshold_and_copies(spark):
    rnd = random.Random(1)
    rows = _spread_rows(rnd, line_spread.MIN_SITES)
    copied = "copied text\nwith two lines"
    rows += [(200 + i, copied, "en", f"s{i}") for i in range(30)]  # one page on many sites
    df = documents(spark, rows).repartition(4)
    got = {r.doc_id: r for r in line_spread.drop_spread_lines(df).collect()}
    assert "common line" in got[0].text and got[0].n_dropped == 0
    for i in range(1, line_spread.MIN_SITES):
        assert "common line" not in got[i].text and got[i].n_dropped == 1
    assert all("rare line" in got[i].text for i in range(line_spread.MIN_SITES - 1))
    assert all(got[200 + i].text == copied for i in range(30))
    assert got[40].text == dict((r[0], r[1]) for r in rows)[40]


def test_lines_far_beyond_the_threshold_use_the_estimate(spark):
    rnd = random.Random(2)
    df = documents(spark, _spread_rows(rnd, 50))
    got = line_spread.drop_spread_lines(df).collect()
    assert sum(r.n_dropped for r in got) == 49 + 48


def test_lines_of_odd_tables(spark):
    rows = odd_rows(random.Random(3))
    df = documents(spark, rows)
    out = line_spread.drop_spread_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert sorted((tuple(r)[:2] for r in out.collect()), key=str) == sorted(rows, key=str)
    assert line_spread.drop_spread_lines(documents(spark, [])).count() == 0
    nowhere = documents(spark, [(i, "same\nline", None, None) for i in range(40)])
    assert {r.n_dropped for r in line_spread.drop_spread_lines(nowhere).collect()} == {0}


def test_only_oversized_buckets_split(spark):
    rnd = random.Random(4)
    rows = [(i, "y" * rnd.randint(0, 4000)) for i in range(300)] + [(999, "z" * 50_000)] + odd_rows(rnd)
    rows += [(7777, "same row " * 20)] * 400   # a hot row
    limit = 20_000
    got = sharding.shard(documents(spark, rows).repartition(6), limit).collect()
    assert len(got) == len(rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.n_bytes)
        assert len(r.shard) == r.depth
    for r in got:
        sizes = shards[r.shard]
        assert r.shard_bytes == sum(sizes) and r.shard_rows == len(sizes)
        assert sum(sizes) <= limit or len(sizes) == 1
    prefixes = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(prefixes, prefixes[1:], strict=False))
    for name in shards:  # every split bucket was over the limit
        if name:
            parent = [b for s, sizes in shards.items() if s.startswith(name[:-1]) for b in sizes]
            assert sum(parent) > limit
    assert sharding.shard(documents(spark, []), limit).count() == 0
    assert {r.shard for r in sharding.shard(documents(spark, [(1, "a"), (2, None)]), limit).collect()} == {""}


def _files(spark, rows):
    return spark.createDataFrame(rows, "path string, text string")


def test_licences_own_inherited_and_none(spark):
    rnd = random.Random(5)

    def filler():
        return prose(rnd, 40, 5000)

    apache = "Licensed under the Apache License, Version 2.0"
    rows = [("a/LICENSE", f"{apache}\n{filler()}"), ("a/x.py", filler()), ("a/b/y.py", filler()),
            ("a/b/c/notice", "Released under the MIT License."), ("a/b/c/z.py", filler()),
            ("a/b/c/own.py", f"# licensed under CC BY-NC 4.0\n{filler()}"), ("d/e.py", filler()),
            ("d/f.py", f"{filler()} license mit"), ("top.py", filler()), (None, None), ("a/b/", ""),
            ("a/x.py", None), ("a/b/gpl.c", f"{filler()}\n/* This work is licensed under the GNU General "
                                            "Public License, version 3. */")]
    got = {(r.path, i): (r.licence, r.origin) for i, r in enumerate(licenses.scan(_files(spark, rows)).collect())}
    by_path = {}
    for (path, _), found in got.items():
        by_path.setdefault(path, set()).add(found)
    assert len(got) == len(rows)
    assert by_path["a/LICENSE"] == {("Apache-2.0", "own")}
    assert by_path["a/x.py"] == by_path["a/b/y.py"] == by_path["a/b/"] == {("Apache-2.0", "inherited")}
    assert by_path["a/b/c/notice"] == {("MIT", "own")} and by_path["a/b/c/z.py"] == {("MIT", "inherited")}
    assert by_path["a/b/c/own.py"] == {("CC-BY-NC-4.0", "own")} and by_path["a/b/gpl.c"] == {("GPL-3.0", "own")}
    assert by_path["d/e.py"] == by_path["d/f.py"] == by_path["top.py"] == by_path[None] == {(None, "none")}


def test_licences_of_odd_tables(spark):
    rows = odd_rows(random.Random(6))
    df = licenses.document_files(documents(spark, rows))
    assert licenses.scan(df).count() == len(rows)
    assert licenses.scan(licenses.document_files(documents(spark, []))).count() == 0


def test_thousands_of_equal_rows_split_to_single_rows(spark):
    rows = [(7, "x" * 100)] * 3000 + [(i, "y" * 50) for i in range(40)]
    got = sharding.shard(documents(spark, rows, clashing=False).repartition(5), 120).collect()
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.n_bytes)
    assert len(got) == len(rows) and all(sum(s) <= 120 for s in shards.values())
