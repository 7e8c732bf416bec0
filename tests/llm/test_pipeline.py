"""The pipeline on the smallest tables, and the registered queries."""

from __future__ import annotations

import collections
import re

import numpy as np
import parity
import pytest
from test_operators import dropped_lines, union_find

import __spark_entry__ as driver
import corpus_pipeline
from demandgrid.llm import decontamination, queries, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert set(queries.QUERIES) <= set(driver.queries()) and "pipeline" in driver.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert parity.differences(driver.queries()[name](spark, SF_DIR), parity.connect(SF_DIR), driver.oracle_sql()[name]) is None


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == columns and 0 < docs.count() <= n, name
        n = docs.count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert mixed.columns == [*columns, "mix_repetition"] and mixed.count() > 0


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def brute_line_dedup(rows):
    groups = dropped_lines(rows)
    keep = {min((p[0], p[2]) for p in g) for g in groups.values()}
    judged = {(p[0], p[2]) for g in groups.values() for p in g}
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        left = [line for i, line in enumerate(lines) if (r.doc_id, i) not in judged or (r.doc_id, i) in keep]
        if len(left) == len(lines):
            out.append((r.doc_id, r.text, r.source))
        elif "\n".join(left).split():
            out.append((r.doc_id, "\n".join(left), r.source))
    return out


def brute_near_duplicates(rows):
    prints = [simhash.fingerprint((t or "").encode()) for _, t, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    return [rows[i] for i, root in enumerate(union_find(len(rows), pairs)) if i == root]


def brute_leaks(rows, items):
    tokens = lambda t: re.findall(r"[^\W_]+", (t or "").lower())

    def leaking(words, item):
        w = min(decontamination.WINDOW, len(item))
        for offset in range(-len(item) + w, len(words) - w + 1):
            first = max(offset, 0)
            same = [words[k] == item[k - offset] for k in range(first, min(len(words), offset + len(item)))]
            if any(sum(same[s : s + w]) >= decontamination.AGREEMENT * w for s in range(len(same) - w + 1)):
                return True
        return False

    sought = [set(i) and i for i in map(tokens, items) if len(i) >= decontamination.MIN_TOKENS]
    out = []
    for row in rows:
        words = tokens(row[1])
        known = set(words)
        if not any(len(known.intersection(i)) >= 0.5 * decontamination.WINDOW * 0.8 and leaking(words, i) for i in sought):
            out.append(row)
    return out


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.train(docs, labels.where(toxicity.training_rows(labels)))
    rows = docs.orderBy("doc_id").collect()
    weights = np.array(model.logistic)
    scores = [1 / (1 + np.exp(-(np.array([*e, 1.0]) @ weights))) for e in model.scorer()([r.text for r in rows])]
    kept = [r for r, s in zip(rows, scores, strict=True) if s < toxicity.THRESHOLD]
    kept = brute_near_duplicates(brute_line_dedup(kept))
    kept = brute_leaks(kept, [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()])
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in kept}
    source = {i: s for i, _, s in kept}
    text = {i: t for i, t, _ in kept}

    result = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in result} <= set(text)
    taken = collections.Counter()
    for r in result:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert text[r.doc_id].startswith(r.text) and r.source == source[r.doc_id]
        taken[r.source] += words
    names = sorted(set(source.values()))
    sizes = {s: sum(n for i, n in size.items() if source[i] == s) for s in names}
    target, left = {}, {s: i % 3 + 1 for i, s in enumerate(names)}
    while left:
        level = (sum(sizes.values()) - sum(target.values())) / sum(left.values())
        over = [s for s in left if level * left[s] >= 3 * sizes[s]]
        if not over:
            target |= {s: level * w for s, w in left.items()}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            del left[s]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
