"""Operator 2: base spans by brute force; recall of the field by form and surroundings, on other names and numbers than its rows hold."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from demandgrid.llm import pii

NAMES = "marta oskar petra quentin ruth stefan ulla viktor".split()
HOSTS = "forest lake planet corner market".split()
ENDS = "com org net at de it pl".split()


@pytest.fixture(scope="module")
def model():
    return pii.train()


def _number(rng, n):
    return "".join(rng.choice("123456789") for _ in range(n))


def _card(rng, separator):
    while True:
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if pii._luhn(digits):
            return separator.join(digits[i : i + 4] for i in range(0, 16, 4))


def _octet(rng):
    return str(rng.choice((rng.randrange(10), rng.randrange(256))))


def _email(rng, at, dot):
    return f"{rng.choice(NAMES)}{at}{rng.choice(HOSTS)}{dot}{rng.choice(ENDS)}"


FORMS = {
    "email": [(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" AT ", " DOT "), (" @ ", " . ")],
    "ip": [" . ", " dot "],
    "card": [".", " / ", " . "],
    "phone": ["( 0{3} ) {3} {2} {3}", "(0{2}) {3} {2} {2}", "({3}) {3}-{4}", "0{1} {2} {2} {2} {2}", "0{3} - {3} - {4}", "0049 {2} {4} {3}"],
}
LEADS = {"email": "mail ", "ip": "from ", "card": "card ", "phone": "call "}
LISTS = {"lines": "\n", "semicolons": " ; ", "commas": " , ", "and": " and "}


def _made(rng, kind, form):
    if kind == "email":
        return _email(rng, *form)
    if kind == "ip":
        return form.join(_octet(rng) for _ in range(4))
    if kind == "card":
        return _card(rng, form)
    return re.sub(r"\{(\d)\}", lambda m: _number(rng, int(m[1])), form)


def _found(text, kind, model):
    spans = pii.field_spans([text], model)[0] + pii.base_spans(text)
    return {text[a:e] for a, e, k in spans if k == kind}


@pytest.mark.parametrize("kind", pii.KINDS)
@pytest.mark.parametrize("around", ["alone", "lead", "words", "upper", *LISTS])
def test_recall_by_kind_and_surroundings(model, kind, around):
    rng = random.Random(77)
    hit = total = 0
    for form in FORMS[kind]:
        for _ in range(8):
            items = [_made(rng, kind, form) for _ in range(6 if around in LISTS else 1)]
            if around == "upper":
                items = [i.upper() for i in items]
            text = LISTS.get(around, "").join(items)
            text = {"lead": f"{LEADS[kind]}{text} now", "words": f"nobody believed {text} yesterday evening"}.get(around, text)
            got = _found(text, kind, model)
            hit, total = hit + sum(i in got for i in items), total + len(items)
    assert hit >= 0.9 * total


@pytest.mark.parametrize("form", FORMS["phone"])
@pytest.mark.parametrize("between", ["\n", " ", " ; ", " , "])
def test_long_lists_are_found_whole(model, form, between):
    rng = random.Random(5)
    items = [_made(rng, "phone", form) for _ in range(400)]  # several pieces
    got = [between.join(items)[a:e] for a, e, k in pii.field_spans([between.join(items)], model)[0] if k == "phone"]
    assert got == items


def test_pieces_cut_and_repeat_no_span():
    for n in (1, pii.PIECE, pii.PIECE + 1, 2 * pii.PIECE - 2 * pii.MARGIN, 5000):
        window = [(i, i + 1, "a") for i in range(n)]
        firsts = [piece[i][0] for piece, low, high in pii._pieces(window) for i in range(low, min(high, len(piece)))]
        assert firsts == list(range(n))
        assert all(len(p) <= pii.PIECE and (p[-1][0] == n - 1 or high + pii.MARGIN <= len(p)) for p, _, high in pii._pieces(window))


def test_text_without_personal_data_stays_alone(model):
    texts = [
        "in 1998 , 2003 and 2011 there were 12 , 40 and 7 of them", "1 2 3 4 5 6 7 8 9 10 11 12", "version 3 . 11 . 2 came on 2024 - 06 - 30",
        "we were at home and dot the i", "3 : 2 , 4 : 1 , 0 : 0", "12 345 678 people and 9 of 10", "pages 10 - 20 , 31 - 44", "dot\n@ \n0", "",
        "it is at 5 . 30 pm on 1 . 2 . 2023", "0 . 5 + 0 . 25 = 0 . 75", "room 12 at the market dot",
    ]
    assert pii.field_spans(texts, model) == [[] for _ in texts]


def _brute_base(text):
    """The patterns as stated, each tried from the left with no shortcuts."""
    spans = []
    for rank, (kind, pattern) in enumerate(zip(pii.KINDS, (pii.EMAIL, pii.IP, pii.CARD, pii.PHONE), strict=True)):
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if not m:
                at += 1
                continue
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and doubled % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), rank, m.end(), kind))
            at = m.end()
    return [f"{kind}:{a}:{e}" for a, _, e, kind in sorted(spans)]


def _random_text(rng):
    bits = ["a", "b.c", "@", "x@y.z", "@@", ".", "-", " ", "+", "1", "23", "255", "256", "0", "007", "1.2.3.4", "+49 (30) 1234567", "4111 1111 1111 1111", "é", "😀", "\n", "_%", "(", ")"]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(60)))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [None, "", *[_random_text(rng) for _ in range(400)], " ".join(_random_text(rng) for _ in range(3000))]
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_email long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in pii.op2_personal_data(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        base = _brute_base(text or "")
        row = rows[i]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        spans = row.spans.split(",") if row.spans else []
        assert set(base) <= set(spans) and len(spans) == len(set(spans))
        places = [(int(a), pii.KINDS.index(k)) for k, a, _ in (s.split(":") for s in spans)]
        assert places == sorted(places)
