"""Drops lines that many documents share. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise

MIN_DOCUMENTS = 10
MIN_POINTS = 1
#: What is stripped from both ends of a line, and what is lower-cased.
BLANKS = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A to Z lower-cased. Other letters stay as they are."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hash(key: Column) -> Column:
    """128 bits, so that even a trillion different lines do not meet by chance."""
    return F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g"))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _keys(text: str, min_points: int) -> Column:
    """Hashes of the different keys of a row's lines."""
    keys = F.filter(F.transform(_lines(text), line_key), lambda k: F.length(k) >= min_points)
    return F.array_distinct(F.transform(keys, _hash))


def shared_lines(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_points: int = MIN_POINTS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Hashes (h, g) of the keys that at least ``min_documents`` different documents hold.

    A key counts once a row, and counts are added up in each task before the shuffle, so a line that
    a third of all documents share sends one number per task. Only keys that enough rows hold are
    then counted by different ids, each id once for a task.
    """
    rows = documents.select(F.col(doc_id).alias("id"), F.explode(_keys(text, min_points)).alias("k")).select("id", "k.h", "k.g")
    often = rows.groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).select("h", "g")
    # no hint: the list grows with the corpus, and adaptive execution splits a key that very many rows hold
    held = rows.join(materialise(often, "frequent-lines"), ["h", "g"]).distinct()
    return held.groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents).select("h", "g")


def dedup_lines(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_points: int = MIN_POINTS,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The documents with their shared lines dropped from ``text``, plus ``n_lines``, ``n_dropped``.

    A line's key is the stripped, lower-cased line; keys of at least ``min_points`` code points found
    in at least ``min_documents`` different documents lose all their lines everywhere. Rows of one
    ``doc_id`` are one document in this count, null being an id like any other; each row keeps its
    own lines. The others stay in order, joined by a newline. A null or empty text is one empty line,
    which has no key and stays. Columns named ``n_lines`` and ``n_dropped`` are replaced; others may
    have any name. An empty table gives an empty table.

    Keys are exploded, hashed and counted; the keys over the threshold come back to the rows that
    hold them as one list for each different text, bounded by its lines. The shared keys are joined
    without a hint, as their number grows with the corpus: adaptive execution splits a key that very
    many rows hold.
    """
    documents = documents.drop("n_lines", "n_dropped")
    shared = materialise(shared_lines(documents, min_documents, min_points, text, doc_id), "shared-lines")
    # rows of equal texts hold the same keys, whatever their ids
    own = [F.xxhash64(text).alias("t"), F.xxhash64(F.lit(1), text).alias("u")]
    hits = (
        documents.select(*own, F.explode(_keys(text, min_points)).alias("k"))
        .select("t", "u", "k.h", "k.g")
        .join(shared, ["h", "g"])
        .groupBy("t", "u")
        .agg(F.collect_set(F.struct("h", "g")).alias("shared"))
    )
    joined = documents.select(F.struct("*").alias("row"), *own).join(hits, ["t", "u"], "left")
    lines = _lines(f"row.{text}")
    kept = F.filter(
        lines,
        lambda line: (F.length(line_key(line)) < min_points) | ~F.array_contains(F.col("shared"), _hash(line_key(line))),
    )
    out = joined.select("row", lines.alias("lines"), F.when(F.col("shared").isNull(), lines).otherwise(kept).alias("kept"))
    return out.select(
        *[F.array_join("kept", "\n").alias(c) if c == text else F.col("row")[c].alias(c) for c in documents.columns],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )
