"""Phrase collocations from a weighted de Bruijn graph of the corpus.

Nodes are phrases of ORDER - 1 words, edges the phrases of ORDER words between overlapping nodes,
weighted by their occurrences. An occurrence at the end of a piece has no edge; its last words are
kept as piece-end corrections. So every position of the corpus is one row, counted once:

1. Words are counted; then pairs of frequent words. No phrase that is frequent enough holds a rarer
   word or pair, so pieces may be cut there without loss. The frequent ones reach the tasks as bit
   tables of a fixed size; a bit that is set by chance lets a rare pair through, which changes no count.
2. Edges and piece ends are counted.
3. The count of a node is the flow out of it: the sum of its edges and of the pieces that end there.
   Phrases one word shorter get theirs from the nodes in the same way, down to two words.
4. Nodes that one edge enters and one edge leaves with the node's whole flow are unary; chains of
   them are compacted into paths. An inner node of a path says nothing that its path does not say.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise
from . import arrow_text as at

ORDER = 5
MIN_COUNT = 100
#: A phrase goes if a longer one around it has at least this share of its occurrences, in percent.
SHARE = 100
TOP = 2000
UNKNOWN = "und"
#: Bits of a table of frequent words or pairs: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
_ROW_BITS = 32768

#: What ends a piece, what parts words, and A to Z.
PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?\x0a\x0b\x0c\x0d"]] = True
_WORD = ~PIECE_ENDS
_WORD[[*b"\x20\x09"]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = at.random_words(2 * ORDER, 21) | np.uint64(1)


@dataclass
class _Chunk:
    """The words of a chunk: where they are, their hash with their language, and who follows whom."""

    data: np.ndarray
    words: at.Words
    langs: list[str]
    lang: np.ndarray  # of each word
    keys: np.ndarray
    follows: np.ndarray  # the next word is in the same piece

    def text(self, places: np.ndarray) -> pa.Array:
        """The words at some places."""
        sizes = self.words.ends[places] - self.words.starts[places]
        ends = np.cumsum(sizes)
        at_byte = np.repeat(self.words.starts[places] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        content = np.ascontiguousarray(self.data[at_byte])
        return pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(content))

    def lang_of(self, places: np.ndarray) -> pa.Array:
        return pa.array(self.langs, pa.string()).take(pa.array(self.lang[places]))


def _chunk(batch: pa.RecordBatch) -> _Chunk:
    data, offsets = at.flat(batch.column("text"))
    data = _LOWER[data]
    words = at.words(data, offsets, _WORD)
    rows = words.texts()
    coded = batch.column("lang").dictionary_encode()
    langs = coded.dictionary.to_pylist()
    salts = np.array([int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in langs], np.uint64)
    lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[rows] if len(rows) else np.zeros(0, np.int64)
    keys = at.mixed(words.hashes ^ salts[lang]) if len(rows) else np.zeros(0, np.uint64)
    follows = np.zeros(len(rows), bool)
    ends = np.cumsum(PIECE_ENDS[data])[words.starts] if len(rows) else np.zeros(0, np.int64)
    follows[:-1] = (ends[1:] == ends[:-1]) & (rows[1:] == rows[:-1])
    return _Chunk(data, words, langs, lang, keys, follows)


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(FILTER_BITS - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _pair_keys(c: _Chunk, places: np.ndarray) -> np.ndarray:
    """Five bytes of hash, to keep the shuffle short: pairs that share one count as frequent together, which loses nothing."""
    return at.mixed(c.keys[places] * _ODD[0] + c.keys[places + 1] * _ODD[1]) & np.uint64((1 << 40) - 1)


def _grams(c: _Chunk, linked: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and hash of the longest phrase from each word that another follows."""
    first = np.flatnonzero(linked)
    size, key = np.ones(len(first), np.int64), c.keys[first] * _ODD[0]
    going = np.ones(len(first), bool)
    for k in range(1, order):
        there = np.minimum(first + k, len(linked) - 1)
        going &= linked[there - 1] & (first + k < len(linked))
        size += going
        key += np.where(going, c.keys[there] * _ODD[k], np.uint64(0))
    return first, size, at.mixed(key)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def bit_table(spark: SparkSession, keys: DataFrame) -> np.ndarray:
    """The hashes ``key`` as bits by their last digits: FILTER_BITS of them, whatever the number of keys."""
    slot = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(slot).alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        begin = (r.row - 1) * _ROW_BITS // 8
        out[begin : begin + _ROW_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def _words_between(phrase: str, first: int, last: int | None) -> Column:
    """Words of a space-joined phrase: the first ``last``, or all from ``first``."""
    if last is not None:
        return F.substring_index(phrase, " ", last)
    return F.expr(f"substring({phrase}, length(substring_index({phrase}, ' ', {first})) + 2)")


@dataclass
class Graph:
    """words (lang, word, n) of at least the least count, totals (lang, n) of all words, and
    flows[k] (lang, phrase, n) of all phrases of k words that any frequent phrase can hold."""

    words: DataFrame
    totals: DataFrame
    flows: dict[int, DataFrame]
    min_count: int

    def phrases(self, size: int) -> DataFrame:
        if size == 1:
            return self.words.select("lang", F.col("word").alias("phrase"), "n")
        return self.flows[size].where(F.col("n") >= self.min_count)


def build_graph(
    documents: DataFrame,
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    text: str = "text",
    lang: str = "lang",
) -> Graph:
    """Counts edges of ``order`` words and piece ends, and derives the shorter counts from them.

    Counts of at least ``min_count`` are exact; phrases below it may lack rows. Words, pairs and
    phrases are added up in each chunk and task before they are shuffled.
    """
    spark = documents.sparkSession
    source = documents.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang")
    )

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            c = _chunk(batch)
            _, first, n = np.unique(c.keys, return_index=True, return_counts=True)
            yield _batch(lang=c.lang_of(first), word=c.text(first).cast(pa.string()), n=pa.array(n, pa.int64()))
            all_words = np.bincount(c.lang, minlength=len(c.langs))
            yield _batch(lang=pa.array(c.langs, pa.string()), word=pa.nulls(len(c.langs), pa.string()),
                         n=pa.array(all_words, pa.int64()))

    counted = source.mapInArrow(count_words, "lang string, word string, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = materialise(counted.where(F.col("word").isNull() | (F.col("n") >= min_count)), "words")
    words = counted.where("word IS NOT NULL")

    def word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            yield _batch(key=pa.array(_chunk(batch).keys.view(np.int64)))

    keys = words.select(F.col("word").alias("text"), "lang").mapInArrow(word_keys, "key long")
    frequent = spark.sparkContext.broadcast(bit_table(spark, keys))

    def linked_words(c: _Chunk) -> np.ndarray:
        held = _held(frequent.value, c.keys)
        linked = c.follows & held
        linked[:-1] &= held[1:]
        return linked

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            c = _chunk(batch)
            keys, n = np.unique(_pair_keys(c, np.flatnonzero(linked_words(c))), return_counts=True)
            yield _batch(key=pa.array(keys.view(np.int64)), n=pa.array(n, pa.int64()))

    pairs = source.mapInArrow(count_pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    pairs_held = spark.sparkContext.broadcast(bit_table(spark, pairs.where(F.col("n") >= min_count)))

    def count_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            c = _chunk(batch)
            linked = linked_words(c)
            places = np.flatnonzero(linked)
            linked[places] = _held(pairs_held.value, _pair_keys(c, places))
            starts, sizes, keys = _grams(c, linked, order)
            # 64 bits of hash tell the phrases of one chunk apart
            _, one, n = np.unique(keys, return_index=True, return_counts=True)
            starts, sizes = starts[one], sizes[one]
            columns = []
            for k in range(order):
                there = c.text(np.minimum(starts + k, len(c.keys) - 1))
                columns.append(pc.if_else(pa.array(sizes > k), there, pa.scalar(None, pa.large_string())))
            joined = pc.binary_join_element_wise(*columns, pa.scalar(" ", pa.large_string()), null_handling="skip")
            yield _batch(lang=c.lang_of(starts), phrase=joined.cast(pa.string()), size=pa.array(sizes, pa.int32()),
                         n=pa.array(n, pa.int64()))

    rows = source.mapInArrow(count_edges, "lang string, phrase string, size int, n long")
    rows = materialise(rows.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")), "edges")
    flows = {order: rows.where(F.col("size") == order).select("lang", "phrase", "n")}
    for size in range(order - 1, 1, -1):
        out = flows[size + 1].select("lang", _words_between("phrase", 0, size).alias("phrase"), "n")
        ended = rows.where(F.col("size") == size).select("lang", "phrase", "n")
        flow = out.unionByName(ended).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        flows[size] = materialise(flow, f"flow-{size}")
    totals = counted.where("word IS NULL").select("lang", "n")
    return Graph(words.select("lang", "word", "n"), totals, flows, min_count)


def compact(graph: Graph) -> DataFrame:
    """Paths (lang, passage, words, n): chains of frequent edges through unary nodes, each edge in one path.

    A node is unary if one edge brings and one edge takes its whole flow. The first edge of a path
    is found by doubling: each edge looks at the edge before it, then two, four, eight before it. A
    chain cannot be longer than a piece, as every occurrence runs through all of it. Chains without
    a first edge (rings) stay single edges.
    """
    order = max(graph.flows)
    edges = graph.phrases(order).select("lang", "phrase", "n", F.xxhash64("lang", "phrase").alias("id"))
    edges = materialise(edges, "edges")
    head = edges.select("lang", _words_between("phrase", 0, order - 1).alias("node"), "n", F.col("id").alias("id"))
    tail = edges.select("lang", _words_between("phrase", 1, None).alias("node"), "n", F.col("id").alias("before"))
    nodes = graph.phrases(order - 1).select("lang", F.col("phrase").alias("node"), "n")
    unary = tail.join(nodes, ["lang", "node", "n"]).join(head, ["lang", "node", "n"]).select("id", "before")
    # up: the edge ``step`` edges further up the chain, or the first one of the path
    state = edges.select("id").join(unary, "id", "left").select(
        "id", F.coalesce("before", "id").alias("up"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("rank")
    )
    state = materialise(state, "chains")
    rounds = max(1, int(edges.count()).bit_length() + 1)
    for _ in range(rounds):
        above = state.select(F.col("id").alias("up"), F.col("up").alias("further"), F.col("rank").alias("more"))
        state, before = materialise(state.join(above, "up").select("id", F.col("further").alias("up"), (F.col("rank") + F.col("more")).alias("rank"),
                                                                   (F.col("more") > 0).alias("moved")), "chains"), state
        moved, state = state.where("moved"), state.drop("moved")
        if moved.isEmpty():
            break
    firsts = state.where("rank = 0").select(F.col("id").alias("up"))
    settled = state.join(firsts, "up", "left_semi")
    alone = state.join(firsts, "up", "left_anti").select("id", F.col("id").alias("up"), F.lit(0).cast("long").alias("rank"))
    member = edges.join(settled.unionByName(alone), "id")
    last_word = F.substring_index("phrase", " ", -1)
    paths = member.groupBy("lang", "up", "n").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.when(F.col("rank") == 0, F.col("phrase")).otherwise(last_word).alias("w")))).alias("all")
    )
    return paths.select(
        "lang", F.array_join(F.col("all.w"), " ").alias("passage"), (F.size("all") + order - 1).cast("long").alias("words"), "n"
    )


def inner_nodes(paths: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, phrase): the nodes inside paths, which were compacted away."""
    split = F.split("passage", " ")
    inside = F.transform(
        F.sequence(F.lit(2), F.col("words").cast("int") - order + 1), lambda k: F.array_join(F.slice(split, k, order - 1), " ")
    )
    return paths.where(F.col("words") > order).select("lang", F.explode(inside).alias("phrase"))


def _independent(graph: Graph, paths: DataFrame, share: int) -> DataFrame:
    """(lang, phrase, size, a) of frequent phrases that no longer frequent phrase around them stands for.

    Counts never grow with length, so it is enough to look one word to the left and to the right.
    """
    order = max(graph.flows)
    kept = [graph.phrases(order).select("lang", "phrase", F.lit(order).alias("size"), F.col("n").alias("a"))]
    for size in range(order - 1, 1, -1):
        phrases = graph.phrases(size)
        if size == order - 1 and share <= 100:
            phrases = phrases.join(inner_nodes(paths, order), ["lang", "phrase"], "left_anti")
        longer = graph.phrases(size + 1)
        around = longer.select("lang", _words_between("phrase", 0, size).alias("phrase"), F.col("n").alias("more")).unionByName(
            longer.select("lang", _words_between("phrase", 1, None).alias("phrase"), F.col("n").alias("more"))
        )
        around = around.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
        left = phrases.join(around, ["lang", "phrase"], "left").where(
            F.col("more").isNull() | (100 * F.col("more") < share * F.col("n"))
        )
        kept.append(left.select("lang", "phrase", F.lit(size).alias("size"), F.col("n").alias("a")))
    out = kept[0]
    for other in kept[1:]:
        out = out.unionByName(other)
    return out


def score_phrases(graph: Graph, paths: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases that stand for themselves, cut where they score least.

    The score is floor(1000 a n / (l r)) in decimals of 38 digits, which hold it for any corpus of
    fewer than 10**17 words.
    """
    order = max(graph.flows)
    candidates = _independent(graph, paths, share)
    counts = graph.words.select("lang", F.col("word").alias("phrase"), "n")
    for size in range(2, order):
        counts = counts.unionByName(graph.phrases(size))
    counts = materialise(counts, "phrase-counts")
    cut = F.col("cut")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "cut",
        F.expr("substring_index(phrase, ' ', cut)").alias("first"),
        F.expr("substring_index(phrase, ' ', cut - size)").alias("rest"),
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    exact = F.expr(
        "CAST(1000 * (CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))) AS DECIMAL(38, 0))"
        " div CAST(CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)) AS DECIMAL(38, 0))"
    )
    scored = cuts.join(graph.totals, "lang").withColumn("score", exact)
    best = F.min(F.struct("score", cut, "l", "r")).alias("best")
    return scored.groupBy("lang", "phrase", "a", "n").agg(best).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score"
    )


def top_collocations(
    documents: DataFrame,
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    share: int = SHARE,
    top: int = TOP,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    Texts are lower-cased (A to Z) and cut into pieces at ``. , ; : ! ?`` and line ends, pieces into
    words at blanks. A phrase has 2 to ``order`` words of one piece, and at least ``min_count``
    occurrences, overlapping ones included. It is dropped if a longer one around it has ``share``
    percent of its occurrences or more. Cut in two at the place of the least score (ties: the first),
    l and r are the occurrences of the parts, n those of all words of the language. Order: score and
    a descending, then the phrase by its bytes.

    A null text is empty; a null language is UNKNOWN; repeated rows count each; other columns are
    ignored; an empty table, or one without frequent phrases, gives no rows.
    """
    graph = build_graph(documents, order, min_count, text, lang)
    scored = score_phrases(graph, compact(graph), share)
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
