"""Document rules: counts with fixed limits, and divergence from the language's distributions.

DataFrame functions only. One pass over the texts gives each document's counts and two histograms,
of character classes and of common words (all others together). Their sums by language are the references. A document is
judged by the Jensen-Shannon distance of its histograms from those of its language, if it is long
enough for its own to mean something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Greatest distances, and the least characters and words with which they are looked at.
MAX_CLASS_DISTANCE, MIN_CLASS_CHARS = 0.3, 300
MAX_WORD_DISTANCE, MIN_WORD_COUNT = 0.26, 100

BLANKS = "\t\n\x0b\x0c\r "
#: Character classes in the order in which they are taken out of a text.
CLASSES = ["[a-z]+", r"[\x20\x09-\x0D]+", r"[^\x00-\x7F]+", "[A-Z]+", "[0-9]+", "[#*$%&|<>]+", r"""[.,;:!?'"()-]+"""]
BLANK_CLASS, SYMBOL_CLASS = 1, 5
#: Common words of the languages.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "was", "for", "it", "with", "as"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist"],
    "fr": ["le", "et", "les", "des", "du", "un", "une", "est", "qui", "dans", "pour", "par"],
    "es": ["el", "los", "las", "del", "por", "con", "para", "se", "una", "su", "que", "la"],
}
WORDS = sorted({w for words in COMMON.values() for w in words})


def measured(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """doc_id, lang, counts and histograms of every row, without the texts."""
    df = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # a text after each class is a column of its own, so that no class is taken out twice
    rests = ["text"]
    for k, pattern in enumerate(CLASSES):
        df = df.withColumn(f"r{k}", F.regexp_replace(rests[-1], pattern, ""))
        rests.append(f"r{k}")
    sizes = [(F.length(a) - F.length(b)).cast("long") for a, b in zip(rests, rests[1:], strict=False)]
    spaced = F.translate("text", BLANKS, " " * len(BLANKS))
    df = df.select(
        "doc_id", "lang", "text",
        F.array(*sizes, F.length(rests[-1]).cast("long")).alias("classes"),
        F.array_remove(F.split(spaced, " ", -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
    )
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, F.lit(WINDOW))))
    df = df.select(
        "doc_id", "lang", "classes",
        n.cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<long>")).alias("hashes"),
        F.filter(F.transform("words", F.lower), lambda w: w.isin(WORDS)).alias("common"),
    )
    placed = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed))
    known = lambda c: F.coalesce(c, F.lit(False))
    again = F.filter("placed", lambda x, i: known(F.get("placed", i - 1)["h"] == x["h"]) | known(F.get("placed", i + 1)["h"] == x["h"]))
    df = df.withColumn("starts", F.when(F.col("placed").isNotNull(), F.array_sort(F.transform(again, lambda x: x["i"]))))
    covered = F.aggregate(
        F.transform("starts", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", i + 1) - s, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda t, x: t + x,
    )
    counts = [(F.size("common") - F.size(F.array_remove("common", w))).cast("long") for w in WORDS]
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda t, x: t + x)
    return df.select(
        "doc_id", "lang", "n_words",
        (total - F.get("classes", F.lit(BLANK_CLASS))).alias("word_chars"),
        F.get("classes", F.lit(SYMBOL_CLASS)).alias("n_symbols"),
        "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        "classes",
        F.array(*counts, F.col("n_words") - F.size("common")).alias("common"),
    ).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays, 0 to 1; null if one of them is empty."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda t, v: t + v)

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    shares = F.zip_with(p, q, lambda a, b: F.struct((a / total(p)).alias("a"), (b / total(q)).alias("b")))
    divergence = F.aggregate(shares, F.lit(0.0), lambda t, x: t + part(x["a"], x["b"]) + part(x["b"], x["a"])) / 2
    return F.when((total(p) > 0) & (total(q) > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def references(rows: DataFrame) -> DataFrame:
    """(lang, ref_classes, ref_common): sums over the rows of a language that the base rules keep."""
    size = len(CLASSES) + 1
    sums = [F.sum(F.get("classes", F.lit(k))).alias(f"c{k}") for k in range(size)]
    sums += [F.sum(F.get("common", F.lit(k))).alias(f"w{k}") for k in range(len(WORDS) + 1)]
    return rows.where(~F.col("base_failed")).groupBy("lang").agg(*sums).select(
        "lang",
        F.array(*[f"c{k}" for k in range(size)]).alias("ref_classes"),
        F.array(*[f"w{k}" for k in range(len(WORDS) + 1)]).alias("ref_common"),
    )


def judge(documents: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """Counts, distances and verdict of every row.

    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept). A row fails the base rules with fewer than 10 words, or
    if more than a fifth of its words lie in five-word windows that the text repeats. ``kept`` is
    false then, or if a distance exceeds its limit in a text that is long enough for it. Distances
    are null where a histogram is empty.

    A null or empty text has no words and fails. Documents without a language share a reference of
    their own. Repeated rows count each in the references. Other columns are ignored; an empty
    table gives an empty one. The references hold one row a language; they are joined without a
    hint, and Spark broadcasts them by their size in bytes.
    """
    rows = materialise(measured(documents, text, doc_id, lang), "quality-counts")
    reference = materialise(references(rows), "quality-references")
    size = F.aggregate("classes", F.lit(0).cast("long"), lambda t, x: t + x)
    out = rows.join(reference, "lang", "left").select(
        "*",
        js_distance(F.col("classes"), F.col("ref_classes")).alias("class_distance"),
        js_distance(F.col("common"), F.col("ref_common")).alias("word_distance"),
        size.alias("__size"),
    )
    far = (F.col("__size") >= MIN_CLASS_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    strange = (F.col("n_words") >= MIN_WORD_COUNT) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "word_distance",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False)) & ~F.coalesce(strange, F.lit(False))).alias("kept"),
    )
