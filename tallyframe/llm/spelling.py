"""Spelling variants: words one edit apart, found by walking all words down a trie at once.

The trie is a table: a node is the hash of a prefix, an edge leads to the prefix that is one code
point longer. The frontier is a table of states (word, position, node, edits): a word goes down its
own path, leaves it once by a replaced or deleted code point, and must then follow the trie to the
end. Each level is a join of the frontier with the level's nodes. States that leave the path arise
only where the next code point goes on, from an edge table that lists two edges at a time.

Of the two tries, one holds the words and one the reversed words. An edit in the second half of a
word is looked for in the first, an edit in the first half in the second, so no state leaves the
path near the root, where every code point goes on. A subtree of one word is a leaf: states that
reach it are compared with the rest of that word, so levels end where words stop sharing prefixes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_path
from ..sources.tables import materialise
from . import arrow_text as at

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Of one run in DELETED a code point is deleted.
DELETED = 199
#: Ends a word in the trie; no word holds it.
END = "$"

#: Bytes a to z; of a two-byte letter (U+00C0 to U+00FF) the first byte, and the second raised by 64.
_LEAD = 0xC3
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(97, 123), *range(0xC0, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), np.uint32(0xEDB88320) ^ (x >> np.uint32(1)), x >> np.uint32(1))
    return x


_CRC = _crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of byte spans, each carried on from the CRC-32 in ``begun``."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    state = begun[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    alive = np.searchsorted(-sizes, -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
    for k, n in enumerate(alive):
        state[:n] = _CRC[(state[:n] ^ data[starts[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _chunk_words(ids: list, texts: pa.Array, min_length: int, deleted: int) -> tuple[list[str], list[int]]:
    data, offsets = at.flat(texts)
    data = _LOWER[data]
    lead = data == _LEAD
    second = np.zeros(len(data), bool)
    second[1:] = lead[:-1]
    marked = np.where(second, data + np.uint8(64), np.where((data < 128) | lead, data, 0)).astype(np.uint8)
    found = at.words(marked, offsets, _LETTERS)
    two = np.concatenate([[0], np.cumsum(lead)])
    points = found.ends - found.starts - (two[found.ends] - two[found.starts])
    long = points >= min_length
    starts, ends, hashes, rows = found.starts[long], found.ends[long], found.hashes[long], found.texts()[long]
    begun = np.array([zlib.crc32(f"{'' if x is None else x}:".encode()) for x in ids], np.uint32)
    crc = crc32_of(data, starts, ends - starts, begun[rows]) if len(starts) else np.zeros(0, np.uint32)
    raw = data.tobytes()
    gone = crc % deleted == 0
    words, counts = [], []
    for k in np.flatnonzero(gone):
        word = raw[starts[k] : ends[k]].decode()
        place = int(crc[k]) % len(word)
        if len(word) > min_length:
            words.append(word[:place] + word[place + 1 :])
            counts.append(1)
    # 64 bits of hash tell the words of one chunk apart
    _, first, n = np.unique(hashes[~gone], return_index=True, return_counts=True)
    at_start, at_end = starts[~gone][first].tolist(), ends[~gone][first].tolist()
    words += [raw[a:b].decode() for a, b in zip(at_start, at_end, strict=True)]
    return words, counts + n.tolist()


def word_counts(
    documents: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    deleted: int = DELETED,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(word, n): the runs of letters of all texts, A to Z lower-cased, one in ``deleted`` misspelt.

    With h the CRC-32 of ``<doc_id>:<run>``, a run loses its code point h % length if ``deleted``
    divides h. Kept are results of at least ``min_length`` code points that occur at least
    ``min_count`` times. A null text holds none; a null doc_id is written as nothing. Counts are
    added up in each task before the shuffle.
    """
    source = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if not source.schema["doc_id"].dataType.simpleString() == "string":
        source = source.withColumn("doc_id", F.col("doc_id").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            words, counts = _chunk_words(batch.column("doc_id").to_pylist(), batch.column("text"), min_length, deleted)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    counted = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


#: A word with END; the word it is on the way to, null on its own path; whether both are reversed; and
#: the first place where it may leave its path.
_STATE = "entry string, target string, back boolean, first long"


def _node(entry: Column, depth: int) -> Column:
    """The node that the first ``depth`` code points lead to."""
    return F.xxhash64("back", F.substring(entry, 1, depth))


def _letter(entry: str, place: int) -> Column:
    """The code point at a place, counted from 0."""
    return F.substring(entry, place + 1, 1)


def _leaving(shared: DataFrame, depth: int) -> DataFrame:
    """States of the words that leave their path at ``depth``.

    ``shared`` are the words whose node at this depth holds others too. A replacing code point is
    greater than its own; the other direction is the same pair. In a run of equal code points the
    last is deleted.
    """
    here = shared.select("entry", "back", "first", _letter("entry", depth).alias("c1"), _letter("entry", depth + 1).alias("c2"))
    here = here.where(F.col("c1") != END).withColumn("node", _node(F.col("entry"), depth))
    # at most one letter of the alphabet each, whatever the number of words
    two_edges = here.groupBy("node", "c2").agg(F.collect_set("c1").alias("choices"))
    begun, rest = F.substring("entry", 1, depth), F.expr(f"substring(entry, {depth + 2})")
    out = here.where(F.col("first") <= depth)
    replaced = (
        out.join(two_edges, ["node", "c2"])
        .select("entry", "back", begun.alias("begun"), rest.alias("rest"),
                "first", F.explode(F.filter("choices", lambda c: c > F.col("c1"))).alias("c"))
        .select("entry", F.concat("begun", "c", "rest").alias("target"), "back", "first")
    )
    deleted = out.where(F.col("c1") != F.col("c2")).select("entry", F.concat(begun, rest).alias("target"), "back", "first")
    return replaced.unionByName(deleted)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): every ordered pair of different words exactly one insertion, deletion or replacement apart.

    ``words`` has a column ``word``; null and repeated words are left out, and no word may hold END.
    An empty table gives no pairs. Levels are written to the shared folder, so a lost executor costs
    one level. A word has at most as many pairs as its length and alphabet allow, however many words
    there are.
    """
    spark = words.sparkSession
    words = words.select("word").where(F.col("word").isNotNull()).distinct()
    forth = F.struct(F.concat("word", F.lit(END)).alias("entry"), F.lit(False).alias("back"), F.floor(F.length("word") / 2).alias("first"))
    back = F.struct(F.concat(F.reverse("word"), F.lit(END)).alias("entry"), F.lit(True).alias("back"),
                    F.ceil(F.length("word") / 2).alias("first"))
    states = words.select(F.explode(F.array(forth, back)).alias("x")).select(
        "x.entry", F.lit(None).cast("string").alias("target"), "x.back", "x.first"
    )
    states = materialise(states, "trie-words")
    least = states.agg(F.min("first")).first()[0]
    if least is None:
        return spark.createDataFrame([], "word string, near string")
    # the levels of one walk, each a folder that is complete before the next begins
    walk, levels, depth = new_path(spark, "trie-walk"), [], least
    while not states.isEmpty():
        if levels:
            left = _leaving(states.where("target IS NULL"), depth - 1)
            states = states.unionByName(left)
        here = states.withColumn("node", _node(F.coalesce("target", "entry"), depth))
        own = F.when(F.col("target").isNull(), F.col("entry"))
        nodes = here.groupBy("node").agg(F.count(own).alias("n"), F.min(own).alias("leaf")).where("n > 0")
        # a subtree of one word holds no other one for itself, and one target at most
        met = here.join(nodes, "node").where("n > 1 OR leaf = target")
        levels.append(f"{walk}/{depth}")
        met.select(*states.columns, (F.col("n") == 1).alias("done")).write.parquet(levels[-1])
        reached = spark.read.schema(f"{_STATE}, done boolean").parquet(levels[-1])
        states = reached.where("NOT done").drop("done")
        depth += 1
    reached = spark.read.schema(f"{_STATE}, done boolean").parquet(*levels)

    def plain(entry: str) -> Column:
        word = F.expr(f"substring({entry}, 1, length({entry}) - 1)")
        return F.when(F.col("back"), F.reverse(word)).otherwise(word)

    found = reached.where("done").select(plain("entry").alias("a"), plain("target").alias("b"))
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("near"))))
    return found.select(both.alias("x")).select("x.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow each other. A form's n is a multiple of its word's, so chains are short and end."""
    roots = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("then"))
        stepped = roots.join(further, "root", "left").select(
            "word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")
        )
        stepped = materialise(stepped, "roots")
        roots = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n), one row each.

    The form is the near word of largest n, ties the smallest in code-point order, if its n is at
    least ``ratio`` times the word's; else null, and the word is its own root. Words are different
    and not null, their n positive, and ``ratio`` is above 1.
    """
    words = materialise(words.select("word", "n"), "words")
    weighed = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = weighed.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    enough = -F.col("best.minus") >= ratio * F.col("n")
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    joined = materialise(joined, "variants")
    roots = _roots(joined.where("form IS NOT NULL"))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    documents: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    deleted: int = DELETED,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The words of all texts grouped by spelling: :func:`group_variants` of :func:`word_counts`.

    Null and empty texts hold no word; repeated rows count each; other columns are ignored; an
    empty table gives an empty one.
    """
    return group_variants(word_counts(documents, min_length, min_count, deleted, text, doc_id), ratio)
