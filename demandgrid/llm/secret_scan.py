"""Operator 4: secrets in texts, by fixed patterns and sliding-window entropy.

Base spans come from three patterns (an assignment to a secret-like name, an access
key id, a long hex run). The method adds spans of kind ``entropy``: candidate strings
are runs of 20 or more key characters with a letter and a digit; a window of 20
characters slides over a candidate, its character counts are kept incrementally (the
entering character is added, the leaving one taken away, and the sum of n*log2(n)
changes by those two terms only), and the candidate is a secret when some window's
Shannon entropy reaches the threshold of its character class (hex, alphanumeric,
base64). Candidates that an allow-list pattern matches, or that overlap a base span,
add nothing; base spans are never suppressed.

Positions are code points. All is DataFrame code: a pattern's matches and the text
between them are extracted in one anchored pass, and lengths add up to positions.

Defined results: a null or empty text has no spans; a text of any length is read whole;
repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import table

# The base patterns, as stated for this operator.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
VALUE_LEAST = 12
# With their least lengths, 18 and 16: a run too short to count holds no other that counts.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Least entropy in bits of a window of 20, by class.
ENTROPY = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
#: Candidates that are no secrets: placeholders, dictionary-like words, slashed paths, uuid-like groups.
#: No pattern repeats a group, which would recurse once per repetition on a long candidate.
ALLOW = (
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx|your[_-]",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z/]*/[A-Za-z]*[0-9]{0,4}$",
    r"^(?!.*[_-]{2})[A-Za-z][A-Za-z_-]*[0-9]{0,4}$",
    r"0123456789|abcdefghij|9876543210",
)


SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _matches(text: str, pattern: str, kind: str) -> Column:
    """Array of (kind, start, end, value) of the matches of ``pattern``, leftmost and not overlapping.

    ``\\G`` makes each piece (gap and match) begin where the last one ended, so a text
    without a match is scanned once.
    """
    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"(?s)\G.*?(?:{pattern})"), F.lit(0))

    def add(state: Column, piece: Column) -> Column:
        value = F.regexp_extract(piece, rf"({pattern})\z", 1)
        end = state["at"] + F.length(piece)
        span = F.struct(F.lit(kind).alias("kind"), (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.when(F.size(pieces) == 0, F.array().cast(SPANS)).otherwise(F.aggregate(pieces, begin, add, lambda s: s["spans"]))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of the windows of ``value``; 0 where it is shorter than one."""
    gain = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)])
    codes = F.transform(F.split(value, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)))
    moves = F.zip_with(
        codes, F.concat(F.array_repeat(F.lit(0), window), codes), lambda come, go: F.struct(come.alias("come"), go.alias("go"))
    )
    moves = F.filter(moves, lambda m: m["come"].isNotNull())

    def step(state: Column, move: Column) -> Column:
        come, go = move["come"], move["go"]
        more = state["n"][come]
        less = state["n"][go] + F.when(come == go, 1).otherwise(0)
        total = state["total"] + gain[more + 1] - gain[more] + F.when(go > 0, gain[F.greatest(less - 1, F.lit(0))] - gain[less]).otherwise(0.0)
        counts = F.transform(
            state["n"], lambda n, j: n + F.when(j == come, 1).otherwise(0) - F.when((j == go) & (go > 0), 1).otherwise(0)
        )
        full = state["seen"] + 1 >= window
        best = F.when(full, F.greatest(state["best"], F.lit(math.log2(window)) - total / window)).otherwise(state["best"])
        return F.struct((state["seen"] + 1).alias("seen"), counts.alias("n"), total.alias("total"), best.alias("best"))

    begin = F.struct(
        F.lit(0).alias("seen"), F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("n"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best")
    )
    return F.aggregate(moves, begin, step, lambda s: s["best"])


def _secret(value: Column) -> Column:
    """Whether a candidate counts: mixed, not allow-listed, and of enough entropy for its class."""
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | value.rlike(pattern)
    least = (
        F.when(value.rlike("^[0-9a-fA-F]+$"), ENTROPY["hex"]).when(value.rlike("^[A-Za-z0-9]+$"), ENTROPY["alnum"])
        .otherwise(ENTROPY["base64"])
    )
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return F.when(mixed & ~allowed, window_entropy(value) >= least).otherwise(False)


def _listed(spans: str) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("e"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["e"].cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end, value) per document."""
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).select(
        "doc_id",
        _matches("text", ASSIGN, "assign").alias("assign"),
        _matches("text", ACCESS, "access").alias("access"),
        _matches("text", HEX, "hex").alias("hex"),
        _matches("text", CANDIDATE, "entropy").alias("candidates"),
    )
    long_enough = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN_VALUE, 1)) >= VALUE_LEAST)
    based = found.select("doc_id", F.concat(long_enough, "access", "hex").alias("base"), "candidates")

    def new(c: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    return based.select("doc_id", "base", F.filter("candidates", lambda c: new(c) & _secret(c["value"])).alias("added"))


def op4_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents")).withColumn("spans", F.concat("base", "added"))
    counts = [(F.size("base") - F.size(F.array_remove(F.col("base.kind"), kind))).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
