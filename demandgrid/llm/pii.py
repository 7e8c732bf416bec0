"""Operator 2: personal data, by fixed patterns and a linear-chain conditional random field.

Base spans come from four patterns with their checks (octets of an ip, Luhn for cards,
digit counts), leftmost and not overlapping per kind; a match that fails its check is
dropped without a retry. The field adds spans that the patterns miss: spelled-out or
broken-up addresses and numbers ("jane at mail dot org", "10 . 0 . 0 . 7", "(030) 123 45 67").
It tags the tokens around every digit or at-sign, is trained by gradient ascent on the exact
likelihood, and is decoded by Viterbi over numpy batches of windows of equal length. A field
span that overlaps a base span is not added.

The training rows are the small labelled table and ``DRAWN`` rows drawn from it with a seed:
its marked spans with new digits and names, alone or in lists of several separators, with and
without words around them, and its unmarked sentences, in either case.

A window is a stretch of text that reaches ``REACH`` characters around its triggers (digits,
at-signs, and the words "at" and "dot" of the two spellings); tokens outside all windows are no
personal data by definition of the tags. A window of more than ``PIECE`` tokens is decoded in
pieces that overlap by two ``MARGIN``s, and a span counts in the piece that holds its first
token outside the margins, so that none is cut; no span of a valid number is longer than a margin.

Positions are code points. Defined results: null and empty texts have no spans; texts are
read whole; repeated rows give repeated results; an empty table gives an empty one; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from demandgrid.llm.base import table

# The base patterns, as stated for this operator.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

DIGIT = re.compile(r"[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
Span = tuple[int, int, str]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(DIGIT.findall(s))


def _emails(text: str) -> Iterator[Span]:
    """EMAIL's matches, without trying it from every character: a match starts with the run of
    local characters that ends at an at-sign, or where the last match ended in that run."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield start, found.end(), "email"
            end = found.end()
        at = text.find("@", max(at + 1, end))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) by start, then kind as listed."""
    spans: list[Span] = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        if "." in text:
            spans += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                spans.append((m.start(), m.end(), "card"))
        if "+" in text:
            spans += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


# --- the field -------------------------------------------------------------------

TAGS = ("O", "B-email", "I-email", "B-ip", "I-ip", "B-card", "I-card", "B-phone", "I-phone")
REACH = 32
PIECE = 512
MARGIN = 64
WIDTH = 1 << 13  # hashed features
DRAWN = 2000
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[_\n]")

#: The labelled table: sentences whose marked parts are personal data. Fixed values.
LABELLED = (
    "write to [email jane at mail dot org] today", "my address is [email bob dot lee at post dot net] thanks",
    "contact [email info ( at ) shop ( dot ) com] now", "reach me : [email k . smith [at] web [dot] de] , please",
    "mail [email anna @ example . com] or call", "mail [email tom @ site . org]", "send it to [email lee _ 7 @ box . fr] .",
    "ask [email rosa [at] lab [dot] org] or me", "to [email max ( at ) town ( dot ) net] today", "is [email jo at firm dot de] yours ?",
    "server [ip 10 . 0 . 0 . 7] is down", "the host [ip 192 . 168 . 1 . 20] answered", "from [ip 8 dot 8 dot 4 dot 4] came",
    "login from [ip 172 . 16 . 254 . 1] failed", "ping [ip 1 dot 1 dot 1 dot 1] again", "at [ip 203 . 0 . 113 . 9] ,",
    "hosts [ip 9 dot 12 dot 200 dot 3] and [ip 31 dot 7 dot 64 dot 5] answered", "it was [ip 52 . 9 . 140 . 6] again",
    "card [card 4111 . 1111 . 1111 . 1111] expires", "paid with [card 5500 / 0000 / 0000 / 0004] yesterday",
    "number [card 4012 . 8888 . 8888 . 1881] , thanks", "visa [card 4222 / 2222 / 2222 / 2222] .",
    "call [phone ( 030 ) 123 45 67] today", "call [phone ( 0221 ) 555 12 345] now", "fax [phone ( 089 ) 44 55 66 77] .", "phone : [phone 0171 - 555 - 0199]", "my number is [phone 0044 20 7946 0018] now",
    "dial [phone ( 212 ) 555 - 0147] or write", "tel . [phone 06 12 34 56 78]", "ring [phone 0049 30 5550 123] , please",
    "meet at 9 today", "in 2024 there were 12 of them", "page 3 of 10", "about 1 . 5 percent", "the dot is at the end",
    "we met at noon on 5 May 2023", "version 2 . 0 is out", "license version 2 . 0 .", "a score of 3 - 1 at home",
    "chapter 4 , section 2 . 1 , page 77", "it cost 1 , 000 dollars", "from 10 to 20", "room 101 at the inn", "sum 12 + 30 = 42",
    "on 2021 - 05 - 17 at 10 : 30", "1 . 2 . 3 is the latest release", "see figure 7 . 2 and table 12", "founded in 1998 , closed in 2005",
    "45 percent of 200 people", "the ratio 16 : 9", "born 3 . 4 . 1970", "look at dot com firms", "isbn 978 3 16 148410 0",
    "index 0 , 1 , 2 , 3 , 4", "id 48213", "order 77120 shipped", "he ran 100 m in 10 . 2 s", "at 5 pm the 3 friends left",
)


def _shape(token: str) -> str:
    if token[0] in "0123456789":
        zeros = len(token) - len(token.lstrip("0"))
        return f"{'z' * min(zeros, 2) if len(token) > 1 else ''}d{min(len(token), 5)}"
    if token[0].isalpha():
        return "x" + str(min(len(token), 3))
    return token


#: Words that the shapes keep. Fixed values.
KEPT = frozenset("at dot mail call phone tel fax card visa from number and or com org net de fr".split())


def _word(token: str) -> str:
    low = token.lower()
    return low if low in KEPT else _shape(token)


@lru_cache(maxsize=1 << 16)
def _slot(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little") % WIDTH


def _features(tokens: list[str]) -> np.ndarray:
    """(tokens, features) hashed word-shape features of each token and its surroundings."""
    shapes = ["<<", "<", "<", *map(_word, tokens), ">", ">", ">>"]
    rows = []
    for i, token in enumerate(tokens):
        c, b, a, s, y, z, w = shapes[i : i + 7]
        small = token.isdigit() and len(token) <= 3 and int(token) <= 255
        near = (f"0{s}", f"1{a}|{s}", f"2{s}|{y}", f"3{a}|{s}|{y}", f"4{b}|{a}|{s}", f"5{s}|{y}|{z}", f"6{b}|{z}", f"7{small}|{a}|{y}", f"8{c}|{b}|{a}|{s}", f"9{s}|{y}|{z}|{w}")
        rows.append([_slot(x) for x in near])
    return np.array(rows, dtype=np.int64).reshape(len(tokens), -1)


def _allowed() -> np.ndarray:
    """Score of a step from tag to tag: a part goes on only from its own kind."""
    steps = np.zeros((len(TAGS), len(TAGS)))
    for i, a in enumerate(TAGS):
        for j, b in enumerate(TAGS):
            if b[0] == "I" and a[1:] != b[1:]:
                steps[i, j] = -1e4
    return steps


def _sentence(marked: str) -> tuple[list[str], list[int]]:
    tokens, tags, kind, first = [], [], None, False
    for piece in re.findall(r"\[(?:email|ip|card|phone) |\](?= |$)|[^\s\[\]]+|\[|\]", marked):
        if piece[0] == "[" and piece[1:-1] in KINDS:
            kind, first = piece[1:-1], True
        elif piece == "]" and kind and "[" not in tokens[-1:] and not (tokens[-2:-1] == ["["]):
            kind = None
        else:
            for token in TOKEN.findall(piece):
                tokens.append(token)
                tags.append(TAGS.index(f"{'B' if first else 'I'}-{kind}") if kind else 0)
                first = False
    return tokens, tags


# Words that drawn rows put into and around spans, and what stands between the spans of a list.
NAMES = "anna ben carla dmitri eva farid greta hugo ines jonas kim lars mia noor olga paul rita sven tara uwe vera wim xenia yara zoe info sales team".split()
HOSTS = "mail post web shop site box example home office data north river stone cloud".split()
ENDS = "com org net de fr eu uk io info es at it".split()
AROUND = "the we saw old list below of our new please send it to or thanks today now again see all was here is on for people who went home and wrote".split()
BETWEEN = (" ", " ", "\n", " ; ", " , ", " and ", " / ", " | ", " or ", "\n- ")
Labelled = tuple[list[str], list[int]]


def _redrawn(tokens: list[str], kind: str, rng: random.Random) -> list[str]:
    """A marked span with other digits and names."""
    out: list[str] = []
    for i, token in enumerate(tokens):
        if token.isdigit() and kind == "ip":
            out.append(str(rng.choice((rng.randrange(10), rng.randrange(10, 256), rng.randrange(256)))))
        elif token.isdigit() and any(t.isdigit() for t in tokens[:i]):
            out.append("".join(rng.choice("0123456789") for _ in token))
        elif token.isdigit():  # the first number keeps its leading zeros
            zeros = len(token) - len(token.lstrip("0"))
            rest = "".join(rng.choice("0123456789") for _ in token[zeros + 1 :])
            out.append(token[:zeros] + (rng.choice("123456789") if zeros < len(token) else "") + rest)
        elif token.isalpha() and token not in ("at", "dot"):
            out.append(rng.choice(ENDS if i == len(tokens) - 1 else HOSTS if {"at", "@"} & set(tokens[:i]) else NAMES))
        else:
            out.append(token)
    return out


def _drawn(labelled: list[Labelled], count: int, seed: int = 2) -> list[Labelled]:
    """Rows in the manner of the labelled ones: their spans alone, in lists and in other surroundings, and unmarked sentences."""
    rng = random.Random(seed)
    spans: dict[str, list[list[str]]] = {k: [] for k in KINDS}
    plain = []
    for tokens, tags in labelled:
        inside = [t for t, y in zip(tokens, tags, strict=True) if y]
        if inside:
            spans[TAGS[next(y for y in tags if y)][2:]].append(inside)
        else:
            plain.append(tokens)
    rows = []
    for _ in range(count):
        words: Labelled = ([], [])

        def add(tokens: list[str], tags: list[int] | None = None, words: Labelled = words) -> None:
            words[0].extend(tokens)
            words[1].extend(tags or [0] * len(tokens))

        add(rng.sample(AROUND, rng.choice((0, 0, 1, 2, 4))))
        if rng.random() < 0.25:
            for _ in range(rng.choice((1, 2, 3))):
                add(_redrawn(rng.choice(plain), "", rng))
                add(TOKEN.findall(rng.choice(BETWEEN)))
        else:
            kind = rng.choice(KINDS)
            form, between = rng.choice(spans[kind]), rng.choice(BETWEEN)
            if rng.random() < 0.3:
                add([rng.choice(("call", "phone", "tel", "from", "card", "mail", "number", "at", "host")), *rng.choice(([], [":"], ["."]))])
            for k in range(rng.choice((1, 1, 2, 3, 5))):
                if k:
                    add(TOKEN.findall(between))
                if rng.random() < 0.2:
                    form = rng.choice(spans[kind])
                made = _redrawn(form, kind, rng)
                add(made, [TAGS.index(f"B-{kind}")] + [TAGS.index(f"I-{kind}")] * (len(made) - 1))
        add(rng.choice(([], [], ["."], [","], ["\n"])))
        add(rng.sample(AROUND, rng.choice((0, 0, 1, 3))))
        if words[0]:
            rows.append(([t.upper() for t in words[0]] if rng.random() < 0.15 else words[0], words[1]))
    return rows


Model = tuple[np.ndarray, np.ndarray]


def train(labelled: tuple[str, ...] = LABELLED, turns: int = 80, rate: float = 0.5, ridge: float = 0.002, drawn: int = DRAWN) -> Model:
    """(state weights, transition weights) by AdaGrad on the log-likelihood (scaled forward-backward over all rows at once)."""
    own = [_sentence(s) for s in labelled]
    rows = sorted([*own, *(_drawn(own, drawn) if drawn else [])], key=lambda r: -len(r[0]))
    k = len(TAGS)
    sizes = np.array([len(t) for t, _ in rows])
    x = np.concatenate([_features(t) for t, _ in rows])
    tags = np.concatenate([y for _, y in rows])
    at = (np.repeat(np.arange(len(rows)), sizes), np.concatenate([np.arange(n) for n in sizes]))
    length = int(sizes.max())
    alive = [int((sizes > i).sum()) for i in range(length)]  # rows go by falling length: those of more than i tokens come first
    begin = np.array([0.0 if t[0] == "I" else 1.0 for t in TAGS])
    hard = np.exp(_allowed())
    given = np.zeros((k, k))
    follows = at[1][1:] > 0
    np.add.at(given, (tags[:-1][follows], tags[1:][follows]), 1)
    state, steps = np.zeros((WIDTH, k)), np.zeros((k, k))
    sum_state, sum_steps = np.full((WIDTH, k), 1e-3), np.full((k, k), 1e-3)
    for _ in range(turns):
        scores = state[x].sum(axis=1)
        local = np.ones((len(rows), length, k))
        local[at] = np.exp(scores - scores.max(axis=1, keepdims=True))
        pair = np.exp(steps) * hard
        alpha, beta = np.zeros_like(local), np.ones_like(local)
        alpha[:, 0] = local[:, 0] * begin
        alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
        for i in range(1, length):
            m = alive[i]
            alpha[:m, i] = (alpha[:m, i - 1] @ pair) * local[:m, i]
            alpha[:m, i] /= alpha[:m, i].sum(axis=1, keepdims=True)
        g_steps = given - ridge * steps
        for i in range(length - 1, 0, -1):
            m = alive[i]
            ahead = local[:m, i] * beta[:m, i]
            before = alpha[:m, i - 1]
            total = ((before @ pair) * ahead).sum(axis=1, keepdims=True)
            g_steps -= ((before / total).T @ ahead) * pair
            beta[:m, i - 1] = ahead @ pair.T
            beta[:m, i - 1] /= beta[:m, i - 1].sum(axis=1, keepdims=True)
        belief = (alpha * beta)[at]
        belief /= -belief.sum(axis=1, keepdims=True)
        belief[np.arange(len(tags)), tags] += 1
        g_state = -ridge * state
        for y in range(k):
            g_state[:, y] += np.bincount(x.ravel(), np.repeat(belief[:, y], x.shape[1]), WIDTH)
        sum_state += g_state**2
        sum_steps += g_steps**2
        state += rate * g_state / np.sqrt(sum_state)
        steps += rate * g_steps / np.sqrt(sum_steps)
    return state, steps


def viterbi(unary: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Best tags of a batch of windows of equal length: unary is (windows, tokens, tags)."""
    begin = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS])
    best, back = unary[:, 0] + begin, []
    for i in range(1, unary.shape[1]):
        through = best[:, :, None] + pair[None]
        back.append(through.argmax(axis=1))
        best = through.max(axis=1) + unary[:, i]
    tags = np.zeros(unary.shape[:2], dtype=np.int64)
    tags[:, -1] = best.argmax(axis=1)
    for i in range(unary.shape[1] - 2, -1, -1):
        tags[:, i] = np.take_along_axis(back[i], tags[:, i + 1][:, None], axis=1)[:, 0]
    return tags


TRIGGER = re.compile(r"[0-9]+|@|\b(?i:at)\b(?=[^\w\n]{1,4}[^\W_]+[^\w\n]{1,4}(?i:dot)\b)|(?<=[^\w\n])(?i:dot)\b(?=[^\w\n]{1,4}[^\W_])")
Token = tuple[int, int, str]


def _windows(text: str) -> Iterator[list[Token]]:
    """Tokens of the stretches around the triggers; stretches that touch are one."""
    start = end = -1
    for hit in TRIGGER.finditer(text):
        if hit.start() - REACH > end:
            if end >= 0:
                yield _tokens(text, start, end)
            start = max(hit.start() - REACH, 0)
        end = hit.end() + REACH
    if end >= 0:
        yield _tokens(text, start, end)


def _tokens(text: str, start: int, end: int) -> list[Token]:
    # a token that the ends of the stretch would cut is left out
    while 0 < start < len(text) and text[start - 1].isalnum() and text[start].isalnum():
        start += 1
    while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
        end -= 1
    return [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text, start, min(end, len(text)))]


def _pieces(window: list[Token]) -> Iterator[tuple[list[Token], int, int]]:
    """Overlapping pieces of a window, and the tokens of each, from and up to which a span may begin."""
    if len(window) <= PIECE:
        yield window, 0, len(window)
        return
    step = PIECE - 2 * MARGIN
    for at in range(0, len(window) - 2 * MARGIN, step):
        last = at + PIECE >= len(window)
        yield window[at : at + PIECE], MARGIN if at else 0, PIECE if last else PIECE - MARGIN


def _valid(kind: str, found: str) -> bool:
    """A field span keeps its kind's form once spelling and spacing are taken away."""
    n = len(_digits(found))
    if kind == "ip":
        parts = DIGIT_RUN.findall(found)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= n <= 19 and _luhn(_digits(found))
    if kind == "phone":
        return 9 <= n <= 15
    parted = SEPARATOR.split(found, 1)
    if len(parted) != 2 or SEPARATOR.search(parted[1][:-2]):  # a country may be spelled like the separator, at the end
        return False
    flat = [re.sub(r"[\s()\[\]]+", "", re.sub(r"(?i)\W*\bdot\b\W*", ".", part)) for part in parted]
    return EMAIL.fullmatch("@".join(flat)) is not None


SEPARATOR = re.compile(r"(?i)\W*(?:\bat\b|@)\W*")
DIGIT_RUN = re.compile(r"[0-9]+")


BATCH = 1 << 16  # tokens decoded at once


def field_spans(texts: list[str], model: Model) -> list[list[Span]]:
    """Spans of the field per text; windows of one length are decoded together."""
    pair = model[1] + _allowed()
    found: list[list[Span]] = [[] for _ in texts]
    waiting: dict[int, list[tuple[int, list[Token], int, int]]] = {}

    def decode(group: list[tuple[int, list[Token], int, int]]) -> None:
        unary = np.stack([model[0][_features([w[2] for w in piece])].sum(axis=1) for _, piece, _, _ in group])
        for (t, piece, low, high), tags in zip(group, viterbi(unary, pair).tolist(), strict=True):
            i = 0
            while i < len(tags):
                j = i + 1
                if tags[i]:
                    while j < len(tags) and tags[j] == tags[i] + 1:
                        j += 1
                    span = (piece[i][0], piece[j - 1][1], TAGS[tags[i]][2:])
                    if low <= i < high and _valid(span[2], texts[t][span[0] : span[1]]):
                        found[t].append(span)
                i = j

    for t, text in enumerate(texts):
        for window in _windows(text):
            for piece, low, high in _pieces(window):
                group = waiting.setdefault(len(piece), [])
                group.append((t, piece, low, high))
                if len(group) * len(piece) >= BATCH:
                    decode(waiting.pop(len(piece)))
    for n in sorted(waiting):
        if n:
            decode(waiting[n])
    return [sorted(spans) for spans in found]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def _scan_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        rows = []
        for own, extra in zip(base, field_spans(texts, model), strict=True):
            free = [s for s in extra if not any(s[0] < b[1] and b[0] < s[1] for b in own)]
            rows.append([{"kind": k, "start": a, "end": e, "base": True} for a, e, k in own] + [{"kind": k, "start": a, "end": e, "base": False} for a, e, k in free])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, SPANS)], names=["doc_id", "spans"])


SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, spans): every span with its kind, code points, and whether a base pattern found it."""
    model = model or train()
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(partial(_scan_batches, model=model), SCHEMA)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    listed = "array_join(transform(array_sort(transform({}, s -> struct(s.start as a, array_position(array('email', 'ip', 'card', 'phone'), s.kind) as k, s.end as e, s.kind as kind))), s -> concat(s.kind, ':', s.a, ':', s.e)), ',')"
    counts = [f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as long) as n_{k}" for k in KINDS]
    return found.selectExpr("doc_id", *counts, f"sha2({listed.format('filter(spans, s -> s.base)')}, 256) as base_sha256", f"{listed.format('spans')} as spans")
