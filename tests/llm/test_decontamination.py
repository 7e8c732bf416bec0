"""Every passage that the check of operator 7 accepts is found by its masks."""

from __future__ import annotations

import math
from itertools import combinations

import pytest

from demandgrid.llm import decontamination as d


def _allowed(n):
    return 0 if n < d.EXACT else n - math.ceil(n * d.AGREEMENT)


@pytest.mark.parametrize("n", range(1, d.WINDOW + 1))
def test_masks_avoid_every_accepted_substitution(n):
    masks = [mask for low, high, mask in d._masks([n]) if low <= n <= high]
    assert masks == [mask for _, _, mask in d._masks([n])]
    for lost in combinations(range(n), _allowed(n)):
        assert any(not {p + at for p in mask} & set(lost) for mask in masks for at in range(n - mask[-1])), lost


def test_all_lengths_together_need_few_masks():
    assert len(d._masks(range(1, d.SPAN + 1))) == 8
    assert len(d._masks([d.SPAN])) == 3


def test_substituted_passages_are_found(spark):
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in (1, 2, 3, 4, 5, 6, 9, 12, 13, 16)}
    rows, leaking = [], set()
    for n, item in items.items():
        size = min(n, 13)
        for lost in combinations(range(size), _allowed(size)):
            leaking.add(len(rows))
            rows.append((len(rows), " ".join("X" if k in lost else w for k, w in enumerate(item[:size]))))
        if n > 1:  # one token too few
            lost = set(range(0, size, max(1, size // (_allowed(size) + 1))))
            rows.append((len(rows), " ".join("X" if k in lost else w for k, w in enumerate(item[:size]))))
    benchmark = spark.createDataFrame([(n, " ".join(i)) for n, i in items.items()], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in d.leaks(docs, benchmark).collect()} == leaking
    longer = {r.item_id for r in d.leaks(docs, benchmark, min_tokens=6).collect()}
    assert longer == {6, 9, 12, 13, 16}


def test_scripts_without_spaces_are_read_by_character(spark):
    item = "\u4eca\u65e5\u306f\u3068\u3066\u3082\u5929\u6c17\u304c\u826f\u3044\u3067\u3059\u306d"
    docs = [(1, f"\u660e\u65e5{item}\u3002 end"), (2, f"a {item[:5]}x{item[6:]} b"), (3, item[::-1]), (4, None), (5, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "\u0e2a\u0e27\u0e22")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.leaks(docs, benchmark).collect()} == {(1, 1), (2, 1)}


def test_empty_tables_and_low_agreement(spark):
    docs = spark.createDataFrame([(1, "a b c", 5)], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([(1, "a b c", "x")], "item_id long, text string, doc_id string")
    assert [(r.doc_id, r.item_id, r.start, r.end) for r in d.leaks(docs, benchmark).collect()] == [(1, 1, 0, 3)]
    assert d.leaks(docs.limit(0), benchmark).count() == d.leaks(docs, benchmark.limit(0)).count() == 0
    with pytest.raises(ValueError):
        d.leaks(docs, benchmark, agreement=0.5)
