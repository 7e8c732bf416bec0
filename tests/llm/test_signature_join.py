"""MinHash near-duplicates against brute force on whole shingle sets."""

from __future__ import annotations

import numpy as np
import pytest
from test_operators import SCHEMA, TEXTS, union_find

from demandgrid.llm import queries, signature_join

SF_DIR = "/root/testdata/sf0.001"


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}


def brute(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    roots = union_find(len(rows), pairs)
    ids = {}
    for (doc, _), root in zip(rows, roots, strict=True):
        ids.setdefault(root, []).append(doc)
    smallest = {root: min([d for d in docs if d is not None], default=None) for root, docs in ids.items()}
    key = lambda row: (row[0] is None, row[0] or 0, row[1], row[2] or 0)
    return sorted(((d, len(s), smallest[r] if s else d) for (d, _), s, r in zip(rows, sets, roots, strict=True)), key=key)


def found(result):
    key = lambda row: (row[0] is None, row[0] or 0, row[1], row[2] or 0)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()), key=key)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    result = queries.QUERIES["op12_signature_join"](spark, SF_DIR)
    assert found(result) == brute([tuple(r) for r in table])
    assert result.where("kept != (doc_id = component_id)").count() == 0


def test_awkward_rows_equal_brute_force(spark):
    rows = [(i, t, None, "a", 0, "clash", "clash") for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[4], (None, TEXTS[0], None, None, None, None, None), (None, "a text that nobody else has at all", None, None, None, None, None)]
    rows += [(50, "word", None, None, None, None, None), (51, "WORD  ", None, None, None, None, None), (52, "Straße STRASSE a b c", None, None, None, None, None)]
    rows += [(60, "many words " * 150_000 + "end", None, None, None, None, None), (61, "many words " * 150_000 + "END", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(signature_join.near_duplicates(docs)) == brute([(r[0], r[1]) for r in rows])
    assert signature_join.near_duplicates(docs.where("doc_id < -1")).count() == 0
    assert found(signature_join.near_duplicates(docs.where("doc_id = 4"))) == [(4, 0, 4), (4, 0, 4)]


@pytest.fixture(scope="module")
def cloud():
    """Copies of one text that differ from it by a little, from each other by more; some are linked only through others."""
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(4000)]
    base, rows = list(rng.choice(vocabulary, 120)), []
    for i in range(150):
        words = list(base)
        for at in rng.choice(len(words), size=int(rng.integers(1, 7)), replace=False):
            words[at] = f"x{i}y{at}"
        rows.append((i + 1, " ".join(words)))
    chain = list(rng.choice(vocabulary, 60))
    for i in range(40):  # each like its neighbour, the ends unlike
        chain[(7 * i) % 60] = f"c{i}"
        rows.append((1000 + i, " ".join(chain)))
    passage = list(rng.choice(vocabulary, 100))  # shared by texts that are not alike enough
    rows += [(2000 + i, " ".join(passage + [f"p{i}q{k}" for k in range(int(rng.integers(15, 60)))])) for i in range(60)]
    return rows


@pytest.mark.parametrize("tile", [4096, 16])
def test_cloud_and_chain_equal_brute_force(spark, cloud, tile):
    docs = spark.createDataFrame(cloud, "doc_id long, text string")
    assert found(signature_join.near_duplicates(docs, tile=tile)) == brute(cloud)


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for size in (1, 30, 3000):
        a = np.unique(rng.integers(0, 1 << 63, size=size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 63, size=size, dtype=np.uint64)]))
        bits = signature_join.parities([a, b])
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    hits = []
    for _ in range(200):
        shared, own = rng.integers(0, 1 << 63, size=160, dtype=np.uint64), rng.integers(0, 1 << 63, size=(2, 20), dtype=np.uint64)
        sig = signature_join.signatures([np.unique(np.concatenate([shared, o])) for o in own], signature_join.COORDINATES)
        hits.append(int((sig[0] == sig[1]).sum()))
    assert abs(np.mean(hits) / signature_join.COORDINATES - 0.8) < 0.02 and min(hits) >= signature_join.MATCHES
