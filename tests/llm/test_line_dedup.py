"""Line deduplication against brute force on the shingles at every character."""

from __future__ import annotations

import collections

import numpy as np
from pyspark.sql import functions as F
from test_operators import similar_pairs, union_find

from demandgrid.llm import line_dedup


def kept(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return sorted(r.doc for r in line_dedup.line_decisions(docs).where("not dropped").collect())


def test_a_typo_in_a_short_line_is_found(spark):
    line = "international broadcasting organisations acknowledge responsibility"
    assert kept(spark, [line, line.replace("acknowledge", "acknewledge"), "an entirely different line of words"]) == [0, 2]


def test_lines_of_every_length_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopü"), size=rng.integers(3, 12))) for _ in range(2000)]
    lines = []
    for n in range(5, 18):
        for _ in range(12):
            line = " ".join(rng.choice(vocabulary, size=n))
            at = int(rng.integers(len(line)))
            lines += [line, line[:at] + "z" + line[at + 1 :], line + "zz", " ".join(line.split()[:-1])]
    roots = union_find(len(lines), similar_pairs(lines))
    found = kept(spark, lines)
    assert set(roots) <= set(found) and len(found) <= len(set(roots)) + 2
    assert collections.Counter(roots).most_common(1)[0][1] > 1


def test_short_lines_and_scripts_without_spaces_are_judged(spark):
    chinese = "这是一行没有空格的中文文本用来测试行去重是否可以正确处理长句子而不遗漏任何一行"
    lines = ["les.", "LES.", "a", "a", "b", "two words", "two words", "", "", " \t", " \t", chinese, chinese + "吗"]
    assert kept(spark, lines) == [0, 2, 4, 5, 7, 8, 9, 10, 11]


def test_parities_rule_out_no_similar_pair(spark):
    rng = np.random.default_rng(4)
    rows = []
    for n in (1, 4, 30, 300, 3000):
        for share in (0.0, 0.5, 0.8, 0.82, 0.95, 1.0):
            both = rng.integers(-(1 << 62), 1 << 62, size=n).tolist()
            kept = int(n * share)
            rows.append((both, both[:kept] + rng.integers(-(1 << 62), 1 << 62, size=n - kept).tolist()))
    sketched = []
    for s, t in rows:
        s, t = (np.unique(np.array(x, dtype=np.int64)).view(np.uint64) for x in (s, t))
        shared = len(np.intersect1d(s, t))
        sketched.append((line_dedup.sketch(s).tolist(), line_dedup.sketch(t).tolist(), len(s), len(t), shared / (len(s) + len(t) - shared) >= 0.8))
    sketched = spark.createDataFrame(sketched, "s array<long>, t array<long>, n int, m int, similar boolean")
    possible = line_dedup.within(F.col("s"), F.col("t"), F.col("n"), F.col("m"), 0.8)
    found = sketched.select(possible.alias("possible"), "similar")
    counts = collections.Counter((r.possible, r.similar) for r in found.collect())
    assert counts[False, True] == 0 and counts[False, False] > 0 and counts[True, True] > 0


def test_band_keys_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    lines = ["".join(rng.choice(list("abc dé"), size=n)) for n in (1, 4, 5, 6, 39, 500, 5000)] + ["x", "  x ", "\U0001f600" * 9]
    whole = line_dedup.band_keys(lines)
    assert (whole[-3] == whole[-2]).all()
    assert (np.vstack([line_dedup.band_keys([line]) for line in lines]) == whole).all()
    assert (line_dedup.band_keys(lines, line_dedup.SHORT_BANDS)[:, : line_dedup.BANDS] == whole).all()
    monkeypatch.setattr(line_dedup, "PIECE", 64)
    assert (line_dedup.band_keys(lines) == whole).all()


def test_bands_share_as_often_as_their_number_says():
    rng = np.random.default_rng(7)
    met = 0
    for _ in range(200):
        line = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), size=224))
        other = line[:199] + "".join(rng.choice(list("0123456789"), size=25))  # 195 of 245 runs in common: 0.796
        a, b = line_dedup.band_keys([line, other])
        met += bool((a == b).any())
    assert met >= 193


def test_no_python_runs_in_tasks(spark, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("Python in tasks")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(spark.range(1)), name, refused)
    line = "international broadcasting organisations acknowledge responsibility"
    assert kept(spark, [line, line.replace("acknowledge", "acknewledge"), "short", "short", "other  words"]) == [0, 2, 4]


def test_native_sketch_is_that_of_the_distinct_shingles(spark):
    lines = ["ab", "  spaces   taken as one ", "aaaaaaaaaaaaaaaa", "\U0001f600é" * 40, "a line of plain words, long enough for many shingles " * 9]
    rows = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    runs = {i: set() for i in range(len(lines))}
    for r in line_dedup._runs(rows.select("h", line_dedup._code_points(F.col("line")).alias("points"))).collect():
        runs[r.h].add(r.s)
    found = {r.h: r for r in line_dedup._sketched(rows).collect()}
    for i, line in enumerate(lines):
        flat = " ".join(w for w in line.split(" ") if w)
        assert found[i].n == len(runs[i]) == len({flat[j : j + 5] for j in range(max(1, len(flat) - 4))})
        assert found[i].bits == line_dedup.sketch(np.array(sorted(runs[i]), dtype=np.int64).view(np.uint64)).tolist()


def test_native_bands_share_as_often_as_they_should(spark, monkeypatch):
    rng = np.random.default_rng(7)
    lines = []
    for _ in range(200):
        line = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), size=224))
        lines += [line, line[:199] + "".join(rng.choice(list("0123456789"), size=25))]  # 195 of 245 runs in common: 0.796
    rows = spark.createDataFrame([(i, line, i) for i, line in enumerate([*lines, "short one", "short two"])], "h long, line string, place long")
    signed = line_dedup._signed(rows)
    keys = {(r.h, r.family): r["keys"] for r in signed.collect()}
    assert sorted(f for h, f in keys if h >= 400) == [0, 0, 1, 1] and len(keys) == 404
    assert sum(not set(keys[i, 0]).isdisjoint(keys[i + 1, 0]) for i in range(0, 400, 2)) >= 193
    monkeypatch.setattr(line_dedup, "PIECE", 64)
    assert {(r.h, r.family): r["keys"] for r in line_dedup._signed(rows).collect()} == keys


def test_a_pair_of_several_mixed_bands_is_made_once(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "TILE", 4)
    bits = [0] * line_dedup.PARITY_WORDS
    rest = [(h, h % 10, [1, 2, 3] if h % 2 else [2, 3, 4], 50, bits) for h in range(30)]
    made = [tuple(r) for r in line_dedup._across(spark.createDataFrame(rest, "h long, root long, ks array<long>, n int, bits array<long>"), 0.8).collect()]
    assert sorted(made) == sorted((a, b) for a in range(30) for b in range(30) if a % 10 < b % 10)


def test_a_shingle_is_hashed_once_and_meets_few_minima(spark):
    plan = line_dedup._signed(spark.createDataFrame([(1, "a line of words", 1)], "h long, line string, place long"))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = plan[: next(i for i, node in enumerate(plan) if "Generate" in node)]
    nearest = [node for node in below if "Aggregate" in node][-1]
    assert nearest.count("min(") <= line_dedup.COLUMNS


def test_very_long_lines_are_compared_as_others(spark, monkeypatch):
    rng = np.random.default_rng(8)
    lines = []
    for n in (3, 30, 63, 64, 65, 200, 1000):
        line = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz \U0001f600"), size=n)).strip()
        lines += [line, line + "zz", line[: n // 2]]
    rows = spark.createDataFrame(list(enumerate(lines)), "h long, line string")
    pairs = spark.createDataFrame([(i, i + k) for i in range(0, len(lines), 3) for k in (1, 2)], "a long, b long")
    found = []
    for piece in (line_dedup.PIECE, 64):
        monkeypatch.setattr(line_dedup, "PIECE", piece)
        texts = line_dedup._sketched(rows)
        found.append((sorted(map(tuple, texts.select("h", "n", "bits").collect())), sorted(map(tuple, line_dedup._verified(pairs, texts, 0.8).collect()))))
    assert found[0] == found[1]
    linked = similar_pairs(lines)
    assert found[0][1] == sorted((a, b) for a, b in map(sorted, linked) if b - a < 3 and a % 3 == 0)


def test_shuffle_files_go_once_the_table_is_written(spark):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    before = shuffled()
    table = line_dedup.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffled() <= before
    assert table.count() == 7


def test_the_join_of_possible_pairs_is_made_once(spark):
    line = "a line of plain words, long enough for many shingles "
    texts = line_dedup._sketched(spark.createDataFrame([(1, line), (2, line + "more"), (3, "another")], "h long, line string"))
    found = line_dedup._verified(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"), texts, 0.8)
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("bit_count" in node for node in plan) <= 1
    assert [tuple(r) for r in found.collect()] == [(1, 2)]


def test_sketches_rule_out_most_pairs_near_the_limit(spark):
    rng = np.random.default_rng(11)
    pairs = []
    for _ in range(60):
        drawn = rng.integers(-(1 << 62), 1 << 62, size=488).tolist()
        s, t = (np.array(x, dtype=np.int64).view(np.uint64) for x in (drawn[:430], drawn[:372] + drawn[430:]))  # 372 of 488 in common: 0.762
        pairs.append((line_dedup.sketch(s).tolist(), line_dedup.sketch(t).tolist()))
    rows = spark.createDataFrame(pairs, "s array<long>, t array<long>")
    possible = line_dedup.within(F.col("s"), F.col("t"), F.lit(430), F.lit(430), 0.8, line_dedup.PARITY_WORDS)
    assert rows.where(possible).count() <= 15
