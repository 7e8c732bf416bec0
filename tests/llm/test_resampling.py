"""Importance resampling against DuckDB, plain Python and Python's sort."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import parity
import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, TEXTS

from demandgrid.llm import queries, resampling

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_source_mix", "op13_importance_resampling"])
def test_query_equals_sql(spark, name):
    assert parity.differences(queries.QUERIES[name](spark, SF_DIR), parity.connect(SF_DIR), queries.ORACLE[name]) is None


def features(text, least, most):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def brute(rows, target, least, most, buckets, min_words, percent):
    counted = [features(t, least, most) for _, t in rows]
    s, t = [0] * buckets, [0] * buckets
    for found, counts in ((counted, s), ([features(x, least, most) for x in target], t)):
        for _, f in found:
            for h in f:
                counts[h % buckets] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for (doc, _), (n_words, f) in zip(rows, counted, strict=True):
        weight = sum(gain[h % buckets] for h in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    order = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = {id(r): i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return [(*r[:4], drawn.get(id(r))) for r in out]


def sortable(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, v or 0) for v in r])


@pytest.mark.parametrize(("least", "most", "percent"), [(1, 1, 50), (1, 2, 100), (2, 3, 10)])
def test_awkward_rows_equal_plain_python(spark, least, most, percent):
    rows = [(i * 10**15 - 7, t, "en", "a", 0, "clash", "clash") for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, TEXTS[0], None, None, None, None, None), (None, None, None, None, None, None, None)]
    rows += [(9, "Über ПРИВЕТ übER `x_y`{z} 12ab-CD " * 30_000, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    target = [TEXTS[2], None, "", "seven wizards boil onions"]
    target_rows = spark.createDataFrame([(t,) for t in target], "text string")
    result = resampling.resample(docs, target_rows, least, most, 100, 5, percent, bits=3, block=4)
    assert sortable(result.collect()) == sortable(brute([(r[0], r[1]) for r in rows], target, least, most, 100, 5, percent))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d", None, None, 0, None, None)], SCHEMA)
    none = docs.where("doc_id < 0")
    assert resampling.resample(none, docs).count() == 0
    assert resampling.resample(docs, none, min_words=1, percent=100).first()["rank"] == 1
    assert resampling.resample(docs, none).first()["rank"] is None


@pytest.mark.parametrize(("bits", "block"), [(2, 3), (16, 7)])
def test_radix_sort_is_a_sort(spark, bits, block):
    edge = [0, 1, -1, (1 << 63) - 1, -(1 << 63), None, 5, 5]
    rows = [(a, b, i) for i, (a, b) in enumerate((a, b) for a in edge for b in edge)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5)
    keys = [("a", True), ("b", False), ("i", False)]
    if bits == 2:  # short keys for the many passes of short digits
        df, rows = df.where("a in (5, 1) and b in (0, 1, 5)"), [r for r in rows if r[0] in (5, 1) and r[1] in (0, 1, 5)]
    got = resampling.radix_sort(df, [(F.col(c), d) for c, d in keys], bits, block).collect()
    wanted = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0, r[2]))
    assert [(r.a, r.b, r.i) for r in sorted(got, key=lambda r: r.position)] == wanted
    assert sorted(r.position for r in got) == list(range(len(rows)))
