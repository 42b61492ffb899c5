"""Finds secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

DataFrame functions only. A candidate is a long run of token characters. Its encoding is inferred
from its characters, and under "random in this encoding" it gets three p-values: chi-squared
uniformity of the alphabet, runs above and below the middle symbol, and serial correlation. They
are combined by Fisher's method, and a string that they reject is not random.

Ordinary text can pass that battery by chance, the more easily the shorter it is. So each string is
also weighed against ordinary text, a model of character pairs from the pieces of a public
vocabulary: the evidence is the number of bits by which it is likelier as a random string. Of
ordinary strings a share of at most 2 ** -b has b bits or more, which makes 2 ** -b a p-value; in each
class of lengths a step-up procedure over all different candidates keeps the expected share of
ordinary strings among the reported ones below the allowed rate, whatever the class holds. Besides,
the evidence must outweigh that only one candidate in RARITY is random.

Work per text grows with its length, and with n log n of its matches: places are running sums, found
by doubling, and no step copies the list of matches so far.
"""

from __future__ import annotations

import json
import math
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise

#: The patterns of the base kinds, in the order of the kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"  # the runs of 24 or more, without listing the short ones
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = "[A-Za-z0-9+/_-]{20,}"

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest: name, alphabet in order.
ENCODINGS = [
    ("decimal", _DIGITS),
    ("hex", _DIGITS + "abcdef"),
    ("upper hex", _DIGITS + "ABCDEF"),
    ("lower", _LOW),
    ("upper", _UP),
    ("base32", _UP + "234567"),
    ("base36", _DIGITS + _LOW),
    ("upper base36", _DIGITS + _UP),
    ("base62", _DIGITS + _UP + _LOW),
    ("base64", _UP + _LOW + _DIGITS + "+/"),
    ("url base64", _UP + _LOW + _DIGITS + "-_"),
    ("any", _UP + _LOW + _DIGITS + "+/-_"),
]
#: First lengths of the length classes, allowed false share, and the least combined p-value of the
#: battery that is taken for random.
LENGTHS = (20, 24, 32, 48, 96)
FALSE_SHARE = 0.05
LEAST_P = 0.01
#: Evidence is counted in quarters of a bit, up to so many bits.
STEPS_A_BIT, MOST_BITS = 4, 80
#: Ordinary candidates for each random one; and of the ordinary model: the vocabulary, its
#: characters, and how often a piece ends after a character.
RARITY = 1000
VOCABULARY = "byte_bpe_50k.json"
CHARACTERS = _UP + _LOW + _DIGITS + "+/-_"
PIECE_ENDS = 0.2


def _stage(value: Column, then) -> Column:
    """``then`` applied to ``value``, which is computed once."""
    return F.transform(F.array(value), then)[0]


def running(values: Column, start, combine) -> Column:
    """``combine`` over each element and all before it, ``start`` being neutral.

    By doubling: every element takes in the one before it, then two, four, eight before it.
    """

    def doubled(sofar: Column, k: Column) -> Column:
        n, back = F.size(sofar), F.pow(F.lit(2), k).cast("int")
        earlier = F.concat(F.array_repeat(start, F.least(back, n)), F.slice(sofar, F.lit(1), F.greatest(n - back, F.lit(0))))
        return F.zip_with(sofar, earlier, combine)

    return _stage(values, lambda v: F.when(F.size(v) < 2, v).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.size(v))).cast("int") - 1), v, doubled)
    ))


_SPANS = "array<struct<start:long,end:long,match:string>>"


def spans(text: Column, pattern: str) -> Column:
    """All leftmost matches that don't overlap: array of (start, end, match), in code points."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = lambda x: F.zip_with(
        F.slice(x["pieces"], 1, F.size(x["found"])), x["found"], lambda p, m: (F.length(p) + F.length(m)).cast("long")
    )
    placed = _stage(F.struct(pieces.alias("pieces"), found.alias("found")), lambda x: F.zip_with(
        running(sizes(x), F.lit(0).cast("long"), lambda a, b: a + b), x["found"],
        lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match")),
    ))
    return F.when(text.rlike(pattern), placed.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def clear_of(tokens: Column, others: Column) -> Column:
    """The tokens that overlap none of the other spans; both are in order and without overlaps of their own.

    The last other span that starts before a token ends decides, so ends and starts are sorted
    together and the greatest end so far is kept.
    """

    def kept(x: Column) -> Column:
        events = F.array_sort(F.concat(
            F.transform(x["others"], lambda o: F.struct(o["start"].alias("at"), F.lit(1).alias("late"), o["end"].alias("end"))),
            F.transform(x["tokens"], lambda t: F.struct(t["end"].alias("at"), F.lit(0).alias("late"), F.lit(-1).cast("long").alias("end"))),
        ))
        reach = _stage(events, lambda e: F.filter(
            F.zip_with(e, running(F.transform(e, lambda y: y["end"]), F.lit(-1).cast("long"), lambda a, b: F.greatest(a, b)),
                       lambda y, m: F.struct(y["late"].alias("late"), m.alias("reach"))),
            lambda y: y["late"] == 0,
        ))
        both = F.zip_with(x["tokens"], reach, lambda t, r: F.struct(t.alias("token"), r["reach"].alias("reach")))
        return F.transform(F.filter(both, lambda y: y["reach"] <= y["token"]["start"]), lambda y: y["token"])

    return F.when((F.size(tokens) > 0) & (F.size(others) > 0), _stage(
        F.struct(tokens.alias("tokens"), others.alias("others")), kept
    )).otherwise(tokens)


def _upper_tail(z: Column) -> Column:
    """Of the normal distribution, by a logistic approximation (error below 2e-4)."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def battery(token: Column) -> Column:
    """(encoding, combined p-value) of a token under the assumption that it is random."""
    narrowest = F.lit(len(ENCODINGS) - 1)
    for k in range(len(ENCODINGS) - 2, -1, -1):
        narrowest = F.when(F.translate(token, ENCODINGS[k][1], "") == "", F.lit(k)).otherwise(narrowest)
    alphabets = F.array(*[F.lit(a) for _, a in ENCODINGS])

    def tests(x: Column) -> Column:
        v, size = x["v"], x["size"]
        n, a = F.size(v).cast("double"), size.cast("double")
        squares = F.aggregate(
            F.sequence(F.lit(0), size - 1), F.lit(0.0), lambda t, s: t + F.pow(n - F.size(F.array_remove(v, s)), F.lit(2.0))
        )
        df = a - 1
        chi = F.greatest(a / n * squares - n, F.lit(1e-9))
        z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        pairs = F.arrays_zip(F.slice(v, 1, F.size(v) - 1).alias("x"), F.slice(v, 2, F.size(v) - 1).alias("y"))
        high = F.size(F.filter(v, lambda s: s * 2 >= size)).cast("double")
        runs = 1 + F.size(F.filter(pairs, lambda p: (p["x"] * 2 >= size) != (p["y"] * 2 >= size)))
        expected = 2 * high * (n - high) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, F.abs(runs - expected) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(12.0)
        mean = x["sum"] / n
        total = F.aggregate(v, F.lit(0.0), lambda t, s: t + (s - mean) * (s - mean))
        serial = F.aggregate(pairs, F.lit(0.0), lambda t, p: t + (p["x"] - mean) * (p["y"] - mean))
        z_serial = F.when(total > 0, F.abs(serial / F.greatest(total, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(12.0)
        logs = [F.ln(F.greatest(p, F.lit(1e-12))) for p in (_upper_tail(z_chi), 2 * _upper_tail(z_runs), 2 * _upper_tail(z_serial))]
        half = -(F.least(logs[0], F.lit(0.0)) + F.least(logs[1], F.lit(0.0)) + F.least(logs[2], F.lit(0.0)))
        # the tail of chi-squared with six degrees of freedom
        return _stage(half, lambda h: F.struct(x["encoding"].alias("encoding"), (F.exp(-h) * (1 + h + h * h / 2)).alias("p")))

    def valued(x: Column) -> Column:
        v = F.transform(F.split(token, ""), lambda c: F.instr(x["alphabet"], c) - 1)
        return _stage(
            F.struct(x["encoding"].alias("encoding"), F.length(x["alphabet"]).alias("size"), v.alias("v")),
            lambda y: _stage(
                F.struct(y["encoding"].alias("encoding"), y["size"].alias("size"), y["v"].alias("v"),
                         F.aggregate(y["v"], F.lit(0.0), lambda t, s: t + s).alias("sum")),
                tests,
            ),
        )

    return _stage(narrowest, lambda k: _stage(
        F.struct(k.alias("encoding"), F.element_at(alphabets, k + 1).alias("alphabet")), valued
    ))


@cache
def ordinary_bits() -> np.ndarray:
    """Bits of each character after each other one in ordinary text; the last row is for the first character.

    Pieces of the vocabulary weigh by the reciprocal of their rank. A piece begins with a letter in
    three of four cases, else with a digit or a sign; digits follow each other evenly.
    """
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    size, letters, digits = len(CHARACTERS), slice(0, 52), slice(52, 62)
    pair, start = np.zeros((size, size)), np.zeros(size)
    for piece, rank in vocabulary.items():
        piece = piece.removeprefix("Ġ")  # the file's sign for a space
        at = [CHARACTERS.find(c) for c in piece]
        if at and min(at) >= 0:
            start[at[0]] += 1 / (rank + 1)
            np.add.at(pair, (at[:-1], at[1:]), 1 / (rank + 1))
    start[letters] = 0.75 * (0.9 * start[letters] / start[letters].sum() + 0.1 / 52)
    start[digits], start[62:] = 0.15 / 10, 0.1 / 4
    seen = pair.sum(axis=1, keepdims=True)
    inside = np.where(seen > 0, pair / np.maximum(seen, 1e-300), start)
    inside[digits], inside[digits, digits] = 0, 0.1
    return -np.log2(np.vstack([(1 - PIECE_ENDS) * inside + PIECE_ENDS * start, start]))


def evidence(token: Column, encoding: Column) -> Column:
    """Bits by which a token is likelier as a random string of its encoding than as ordinary text."""
    size = len(CHARACTERS)
    bits = F.split(F.lit(",".join(f"{x:.3f}" for x in ordinary_bits().ravel())), ",").cast("array<double>")
    each = F.element_at(F.array(*[F.lit(math.log2(len(a))) for _, a in ENCODINGS]), encoding + 1)
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(CHARACTERS), c) - 1)
    ordinary = F.aggregate(
        codes,
        F.struct(F.lit(size).alias("last"), F.lit(0.0).alias("bits")),
        lambda t, c: F.struct(c.alias("last"), (t["bits"] + F.element_at(bits, t["last"] * size + c + 1)).alias("bits")),
        lambda t: t["bits"],
    )
    return ordinary - F.length(token) * each


def cut_offs(seen: DataFrame, false_share: float = FALSE_SHARE) -> dict[int, int]:
    """The least step of evidence that is reported, by length class, from (length_class, step) of all different candidates.

    Step-up (Benjamini and Hochberg) on p-values 2 ** (-step / STEPS_A_BIT): the least step s for
    which this p-value times the number of candidates is within ``false_share`` of the candidates at
    s or above. A null step is a candidate that the battery rejects; it counts among the candidates.
    At most (lengths x steps) counts reach the driver.
    """
    counts: dict[int, dict[int, int]] = {}
    for r in seen.groupBy("length_class", "step").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r.length_class, {})[-1 if r.step is None else r.step] = r.n
    floor = math.ceil(STEPS_A_BIT * math.log2(RARITY / false_share))
    least = {}
    for size, found in counts.items():
        candidates, above = sum(found.values()), 0
        for step in range(STEPS_A_BIT * MOST_BITS, floor - 1, -1):
            above += found.get(step, 0)
            if 2 ** (-step / STEPS_A_BIT) * candidates <= false_share * above:
                least[size] = step
    return least


def scan(
    documents: DataFrame, false_share: float = FALSE_SHARE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, found) per row; found is the array of (start, end, kind, match), sorted.

    Kinds: assign (a named secret with a value of 6 or more characters), access (key ids of 20 or
    more), hex (24 or more digits) and random (candidates that the battery and their evidence take for
    random and that overlap none of the other kinds). Places are in code points, the end exclusive;
    the order is by start, then kind in the order above. Strings of decimal digits alone are never
    random: plain numbers look the same.

    A null or empty text holds nothing. Repeated rows give repeated results; a string counts once
    in the statistics, however many copies there are; a null doc_id is carried; other columns are
    ignored; an empty table gives an empty one. The statistics cover all rows: different candidates,
    by 128 bits of hash and combined before the shuffle, then a table of counts.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(spans(content, ASSIGN), lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= 6)
    access = F.filter(spans(content, ACCESS), lambda x: F.length(x["match"]) >= 20)
    # a base kind of token characters alone lies within one token
    plain = F.filter(F.col("tokens"), lambda x: ~x["match"].rlike("[0-9a-f]{24}") & ~x["match"].rlike("AKIA[A-Z0-9]{16}"))
    tested = F.transform(
        clear_of(plain, F.col("assign")),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), battery(x["match"]).alias("b")),
    )
    length_class = lambda x: F.aggregate(
        F.array(*[F.lit(n) for n in LENGTHS]), F.lit(-1), lambda k, n: k + (F.length(x["match"]) >= n).cast("int")
    )
    rows = (
        documents.select(
            F.col(doc_id).alias("doc_id"), assign.alias("assign"), access.alias("access"),
            spans(content, HEX).alias("hex"), spans(content, CANDIDATE).alias("tokens"),
        )
        .withColumn("tested", F.when(F.size("tokens") > 0, tested).otherwise(F.array().cast("array<struct<start:long,end:long,match:string,b:struct<encoding:int,p:double>>>")))
        .select("doc_id", "assign", "access", "hex", F.transform("tested", lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"),
            length_class(x).alias("length_class"),
            F.when((x["b"]["p"] >= LEAST_P) & (x["b"]["encoding"] > 0), F.least(
                F.floor(F.greatest(evidence(x["match"], x["b"]["encoding"]), F.lit(0.0)) * STEPS_A_BIT), F.lit(STEPS_A_BIT * MOST_BITS)
            )).cast("int").alias("step"),
        )).alias("tested"))
    )
    rows = materialise(rows, "secret-spans")
    seen = rows.select(F.explode("tested").alias("x")).select(
        "x.length_class", "x.step", F.xxhash64("x.match").alias("h"), F.xxhash64(F.lit(1), "x.match").alias("g")
    ).distinct()
    least = cut_offs(seen, false_share)

    def random(x: Column) -> Column:
        hit = F.lit(False)
        for size, step in sorted(least.items()):
            hit = hit | ((x["length_class"] == size) & (F.coalesce(x["step"], F.lit(-1)) >= step))
        return hit

    def listed(column: Column, kind: int) -> Column:
        return F.transform(column, lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("k"), x["end"].alias("end"), x["match"].alias("match")
        ))

    every = F.array_sort(F.concat(
        listed(F.col("assign"), 0), listed(F.col("access"), 1), listed(F.col("hex"), 2),
        listed(F.filter(F.col("tested"), random), 3),
    ))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return rows.select("doc_id", F.transform(every, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.element_at(kinds, x["k"] + 1).alias("kind"), x["match"].alias("match")
    )).alias("found"))
