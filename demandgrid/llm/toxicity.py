"""Operator 1: toxicity by a subsequence-kernel SVM with Nyström landmarks.

A sentence is read as its strings: words with inner punctuation squeezed out
("i.d-i*o t" and "id-iot" become "idiot"), words split at punctuation, and runs of
single letters joined. Two strings, each between a start and an end mark, are compared by the
subsequence kernel: all three-letter subsequences, contiguous or not, weighted by ``DECAY`` to the power of the
span they take, up to ``MAX_SPAN`` letters; normalised to 1 for equal strings. Letters
inserted into an insult therefore only weaken the match.

Training is multiple-instance: the sentences of a toxic document hold some toxic string,
those of a clean one none. The strings that witness toxicity are those whose document
counts differ between the classes beyond chance for the number of strings tried; the
negatives are strings of clean sentences, with the hardest added in turns. The SVM is
linear in the Nyström features of ``LANDMARKS`` strings. Since the kernel is a dot
product of subsequence counts, the trained decision collapses to one weight per
three-letter subsequence, so any number of strings is scored by table look-ups.

A text's score is a logistic function, fitted on the training documents, of the largest
margin of its strings, the number of its words that lie on the toxic side, and its number
of words (a long text meets a toxic-looking string by chance). Labels, language, source
and id are never inputs of a score.

Bounds (documented parameters): the classifier is fitted on at most ``MAX_TOXIC`` and
``MAX_CLEAN`` labelled documents, chosen by hash. Everything else covers all rows.

Defined results: null and empty texts have no strings and get the score of the lowest
margin; without a toxic training label every score is that of the base rate; repeated
label rows count once each; null labels are not trained on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.llm.base import materialize, table

LETTERS = 64
DECAY = 0.7
MAX_SPAN = 7
LANDMARKS = 96
MAX_TOXIC = 4_000
MAX_CLEAN = 8_000
MAX_STRINGS = 400
MAX_NEGATIVES = 6_000
THRESHOLD = 0.7
LONGEST = 32  # longer strings are scored as overlapping pieces of this length
CACHED = 600_000
TEXTS = 512  # texts scored together

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_PART = bytes(32 if c in _PUNCTUATION else c for c in range(256))
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_]\s){3,}[^\W\d_](?!\S)")


def _words(text: str | None) -> tuple[list[bytes], set[bytes]]:
    """The words of a text, split at punctuation, and all its strings, as UTF-8."""
    if not text:
        return [], set()
    low = text.lower()
    data = low.encode("utf-8", "replace")
    words = data.translate(_PART).split()
    found = set(words)
    found.update(data.translate(None, _PUNCTUATION).split())
    found.update("".join(run.split()).encode() for run in _SPELLED.findall(low))
    return words, found


def strings(text: str | None) -> set[str]:
    """The strings of a text."""
    return {s.decode("utf-8") for s in _words(text)[1]}


def _pieces(s: str) -> list[str]:
    if len(s) <= LONGEST:
        return [s]
    step = LONGEST // 2
    return [s[i : i + LONGEST] for i in range(0, len(s) - step, step)]


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array([t for t in combinations(range(length), 3) if t[2] - t[0] < MAX_SPAN], dtype=np.int64).reshape(-1, 3)
    return at, (DECAY ** (at[:, 2] - at[:, 0] + 1.0)).astype(np.float32)


def _grouped(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: places in ``words``, codes (words x subsequences), weights of the subsequences."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(lengths):
        at, weights = _triples(int(n) + 2)
        where = np.nonzero(lengths == n)[0]
        for part in np.array_split(where, max(1, len(where) // 4096)):
            points = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le"), dtype=np.uint32).reshape(len(part), n)
            inner = np.where((points >= 97) & (points < 123), points - 97, 26 + points % (LETTERS - 28)).astype(np.int64)
            letter = np.empty((len(part), n + 2), dtype=np.int64)
            letter[:, 0], letter[:, 1:-1], letter[:, -1] = LETTERS - 2, inner, LETTERS - 1
            codes = (letter[:, at[:, 0]] * LETTERS + letter[:, at[:, 1]]) * LETTERS + letter[:, at[:, 2]]
            yield part, codes, weights


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """sqrt(K(s, s)) per row."""
    order = np.argsort(codes, axis=1)
    ranked = np.take_along_axis(codes, order, axis=1)
    first = np.ones(ranked.shape, dtype=bool)
    first[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    starts = np.nonzero(first.ravel())[0]
    sums = np.add.reduceat(weights[order].ravel(), starts)
    return np.sqrt(np.bincount(starts // codes.shape[1], weights=sums.astype(np.float64) ** 2, minlength=len(codes)))


def _features(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per word its distinct subsequence codes and their normalised weights."""
    codes: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
    values: list[np.ndarray] = [np.empty(0)] * len(words)
    for part, found, weights in _grouped(words):
        for row, i in enumerate(part):
            code, back = np.unique(found[row], return_inverse=True)
            value = np.bincount(back, weights=weights, minlength=len(code))
            codes[i], values[i] = code, value / (np.linalg.norm(value) or 1.0)
    return codes, values


def kernel(words: list[str], others: list[str]) -> np.ndarray:
    """Normalised subsequence kernel of two lists of strings."""
    codes, values = _features(others)
    used = np.unique(np.concatenate([*codes, np.empty(0, np.int64)]))
    right = np.zeros((len(others), len(used)))
    for j, (c, v) in enumerate(zip(codes, values, strict=True)):
        right[j, np.searchsorted(used, c)] = v
    out = np.zeros((len(words), len(others)))
    for i, (c, v) in enumerate(zip(*_features(words), strict=True)):
        at = np.searchsorted(used, c)
        known = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == c) if len(used) else np.zeros(len(c), bool)
        out[i] = right[:, at[known]] @ v[known]
    return out


@dataclass
class Model:
    """One weight per subsequence, a bias, and the logistic function of the margin."""

    weights: np.ndarray
    bias: float
    logistic: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 0.0)

    def margins(self, words: list[str]) -> np.ndarray:
        """Margins, not below -1; exact wherever a cheap upper bound exceeds that."""
        out = np.full(len(words), -1.0)
        for part, codes, weights in _grouped(words):
            if not codes.shape[1]:
                continue
            raw = self.weights[codes] @ weights
            least = np.sqrt(float((weights.astype(np.float64) ** 2).sum()))
            near = np.nonzero((raw > 0) & (raw / least + self.bias > -1) | (raw <= 0) & (self.bias > -1))[0]
            if len(near):
                out[part[near]] = np.maximum(-1.0, raw[near] / _norms(codes[near], weights) + self.bias)
        return out

    def scorer(self) -> Callable[[list[str | None]], list[list[float]]]:
        """A function from texts to evidence (margin, the same on a steep ramp, toxic words,
        words) that remembers the strings it has met."""
        known: dict[bytes, float] = {}

        def learn(new: list[bytes]) -> None:
            pieces = [(s, p) for s in new for p in _pieces(s.decode("utf-8"))]
            for (s, _), m in zip(pieces, self.margins([p for _, p in pieces]).tolist() if pieces else [], strict=True):
                known[s] = max(m, known.get(s, -1.0))

        def evidence(texts: list[str | None]) -> list[list[float]]:
            read = [_words(text) for text in texts]
            everything = set().union(*(found for _, found in read))
            if len(known) + len(everything) > CACHED:
                known.clear()
            learn([s for s in everything if s not in known])
            out = []
            for words, found in read:
                most = max(map(known.__getitem__, found), default=-1.0)
                hits = 0
                if most > 0:
                    toxic = {s for s in found if known[s] > 0}
                    hits = len(toxic.difference(words)) + sum(w in toxic for w in words)
                out.append([most, min(1.0, max(0.0, 2 * most - 0.5)), float(np.log1p(hits)), float(np.log1p(len(words)))])
            return out

        return evidence

    def probability(self, evidence: str) -> Column:
        linear = F.lit(float(self.logistic[-1]))
        for i, w in enumerate(self.logistic[:-1]):
            linear = linear + F.lit(float(w)) * F.col(evidence)[i]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear))


def _svm(features: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps; the last feature is the bias."""
    w = np.zeros(features.shape[1])
    ridge = np.eye(features.shape[1])
    for _ in range(50):
        slack = np.maximum(0.0, 1 - y * (features @ w))
        on = slack > 0
        x = features[on]
        gradient = w - 2 * x.T @ (cost[on] * y[on] * slack[on])
        step = np.linalg.solve(ridge + 2 * (x * cost[on, None]).T @ x, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _spread(words: list[str], count: int) -> list[str]:
    """Landmarks: farthest-first in the kernel, so that families of strings are all covered."""
    if len(words) <= count:
        return list(words)
    chosen, near = [0], kernel(words, [words[0]])[:, 0]
    while len(chosen) < count:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, kernel(words, [words[chosen[-1]]])[:, 0])
    return [words[i] for i in chosen]


def fit_strings(positive: list[str], negative: list[str], doubt: list[float] | None = None, turns: int = 3) -> Model:
    """The SVM between two lists of strings, with the hardest negatives added in turns.

    ``doubt`` is, per positive string, the number of clean documents to a toxic one
    that holds it: it is trained as a negative too, with that weight.
    """
    doubts = np.array(doubt or [0.0] * len(positive))
    if not positive or not negative:
        return Model(np.zeros(LETTERS**3, np.float32), -1.0)
    used = negative[: max(500, len(negative) // 4)]
    model = None
    for _ in range(turns):
        marks = _spread(positive, LANDMARKS * 2 // 3)
        marks = list(dict.fromkeys(marks + _spread(used[: 4 * LANDMARKS], LANDMARKS - len(marks))))
        values, vectors = np.linalg.eigh(kernel(marks, marks))
        keep = values > 1e-6
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        words = positive + used + positive
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(used) + len(positive))])
        x = np.hstack([kernel(words, marks) @ whiten, np.ones((len(words), 1))])
        cost = np.concatenate([np.full(len(positive), 1 / len(positive)), np.full(len(used), 1 / len(used)), doubts / len(positive)])
        cost *= 10 * np.sqrt(len(positive) + len(used))
        w = _svm(x, y, cost)
        beta, table_ = whiten @ w[:-1], np.zeros(LETTERS**3)
        for b, c, v in zip(beta, *_features(marks), strict=True):
            table_[c] += b * v
        model = Model(table_.astype(np.float32), float(w[-1]))
        rest = [s for s in negative if s not in set(used)]
        if not rest:
            break
        hard = np.argsort(-model.margins(rest), kind="stable")[:1000]
        used = used + [rest[i] for i in hard]
    return model


def _calibrate(evidence: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weights and offset of the logistic function, lightly ridged."""
    x = np.hstack([evidence, np.ones((len(evidence), 1))])
    w = np.zeros(x.shape[1])
    ridge = 0.1 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - labels)) + ridge @ w)
    return tuple(w.tolist())


def _each_text(batches: Iterator[pa.RecordBatch], make: Callable[[], Callable], name: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Replaces the last column (texts) by what the made function returns for a list of them."""
    work = make()
    for whole in batches:
        for start in range(0, max(1, whole.num_rows), TEXTS):
            batch = whole.slice(start, TEXTS)
            values = pa.array(work(batch.column(batch.num_columns - 1).to_pylist()), type=kind)
            names = [*batch.schema.names[:-1], name]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=names)


def training_rows(labels: DataFrame) -> Column:
    """Rows that may be learned from: crc32 of doc_id as text, modulo 3, is not 1."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels`` holds doc_id and toxic (0 or 1); ``docs`` doc_id and text."""
    usable = labels.select(F.col("doc_id").alias("id"), "toxic").where("id is not null and toxic in (0, 1)")
    prior = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    by_hash = lambda kind, n: usable.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = by_hash(1, MAX_TOXIC).union(by_hash(0, MAX_CLEAN))
    sample = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("toxic", "text")  # at most 12,000 short rows
    sample = materialize(sample, "toxicity-sample")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(LETTERS**3, np.float32), -1.0, (0.0, 0.0, 0.0, 0.0, 30.0 if toxic else -30.0))

    def found() -> Callable:
        return lambda texts: [sorted(strings(text)) for text in texts]

    words = sample.mapInArrow(lambda b: _each_text(b, found, "words", pa.list_(pa.string())), "toxic int, words array<string>")
    counts = words.select("toxic", F.explode("words").alias("s")).groupBy("s").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
    counts = materialize(counts.where(F.length("s") >= 3), "toxicity-strings")
    n = counts.count()
    share = toxic / (toxic + clean)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    total = F.col("a") + F.col("b")
    ratio = 2 * (part(F.col("a"), total * share) + part(F.col("b"), total * (1 - share)))
    scored = counts.withColumn("g", F.when(F.col("a") > total * share, ratio).otherwise(0.0))
    top = scored.orderBy(F.desc("g"), "s").limit(MAX_STRINGS).collect()
    sure = [r for r in top if r.g >= 2 * np.log(n / 0.1) and r.b * toxic * 5 <= r.a * clean]
    positive = sure or [r for r in top[:10] if r.g > 0]
    rest = scored.where((F.col("g") < 4) & (F.col("b") > 0))
    frequent = rest.orderBy(F.desc("b"), "s").limit(MAX_NEGATIVES // 4).collect()
    other = rest.orderBy(F.xxhash64("s"), "s").limit(MAX_NEGATIVES).collect()
    odds = prior[0] / prior[1]
    doubt = [r.b * toxic / (r.a * clean) * odds for r in positive]
    model = fit_strings([r.s for r in positive], list(dict.fromkeys(r.s for r in [*frequent, *other])), doubt)
    seen = sample.mapInArrow(lambda b: _each_text(b, model.scorer, "e", pa.list_(pa.float64())), "toxic int, e array<double>").collect()
    truth = np.array([float(r.toxic) for r in seen])
    model.logistic = _calibrate(np.array([r.e for r in seen]), truth, np.where(truth > 0, 1.0, odds * toxic / clean))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score``, 0 to 1, in place of an existing one of that name."""
    kept = [c for c in docs.columns if c != "score"]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__evidence", T.ArrayType(T.DoubleType()))])
    scored = rows.mapInArrow(lambda b: _each_text(b, model.scorer, "__evidence", pa.list_(pa.float64())), schema)
    return scored.select(*[F.col(f"`{c}`") for c in kept], model.probability("__evidence").alias("score"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(training_rows(labels)))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    scored = score(docs.select("doc_id", "text"), model).select("doc_id", "score")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose score reaches the threshold."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return score(rows, model).where(F.col("score") < threshold).select("row.*")
