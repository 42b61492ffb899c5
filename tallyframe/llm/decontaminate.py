"""Finds benchmark passages in documents by edit distance, through CGK embeddings.

The CGK random walk copies a sequence into a longer one: at each step the current token is
written, and a random bit of (step, token) decides whether to move on. Two sequences at a small
edit distance walk in step after each edit, so their embeddings differ in few places: edit distance
becomes Hamming distance, and bit sampling finds near pairs. Tokens are words in lower case.

Items are few and are broadcast in blocks of bounded size; documents are read once for each block
and nothing is shuffled. For every document:

0. Walks drift apart with every insertion and deletion, so items of more than LONGEST words are cut
   into equal parts. Of a passage with at most k edits some part has no more than its share of k, so
   it is enough to look for the parts as for short items; a part found proposes the whole item.
1. Windows of an item's size start at every word. A window within the allowed distance k of an item
   of L words holds at least L - 2 - 3k of the item's word triples (q-gram lemma), so windows that
   hold fewer benchmark triples are passed over without loss.
2. The remaining window starts are embedded, once for each repetition, all starts at a time. A
   repetition samples steps of the walk over the length of the shortest item of a length class, and
   a window whose sample equals an item's is a candidate.
3. Candidates are verified: the exact least edit distance between the item and any part of the
   document near the window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from ..sources.tables import materialise
from . import arrow_text as at

#: Edits allowed for each word of an item: similarity of 0.8.
MAX_EDITS = 0.2
#: Chance that one window at the largest allowed distance is found. Its neighbours are sampled as
#: well, so the measured recall of passages is higher (see tests).
RECALL = 0.99
#: Words of a part at most; up to here the samples below reach that recall (see tests).
LONGEST = 59
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 16 << 20
#: Steps that one repetition compares, and the chance that two walks agree at a step when a fifth of
#: the words are edited (measured, see tests).
SAMPLE, AGREEMENT = 2, 0.33
Q = 3
CHUNK_BYTES = 4 << 20


def repetitions(recall: float = RECALL, sample: int = SAMPLE, agreement: float = AGREEMENT) -> int:
    """How many samples find a pair at the largest allowed distance with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sample))


def walk(
    tokens: np.ndarray, starts: np.ndarray, stops: np.ndarray, steps: np.ndarray, seeds: np.ndarray
) -> Iterator[np.ndarray]:
    """The embeddings of tokens[start:stop], one step at a time: a row for each seed, a column for each start.

    A seed's row ends after its number of ``steps``; these must not rise. Past its end a sequence
    writes 0, as the embedding pads.
    """
    most = int(steps[0])
    odd = at.mixed(at.random_words(most, 100)[:, None] ^ at.random_words(int(seeds.max()) + 1, 101)[seeds]) | np.uint64(1)
    p = np.tile(starts, (len(seeds), 1))
    padded = np.append(tokens, np.uint64(0))
    for k in range(most):
        p = p[: np.count_nonzero(steps > k)]
        here = padded[np.where(p < stops, p, len(tokens))]
        yield here
        p += ((here * odd[k, : len(p), None]) >> np.uint64(63)).astype(np.int64)


def sample_steps(n_words: int, sample: int, seed: int) -> np.ndarray:
    """Steps of one repetition: spread over a walk through ``n_words`` words, about 2 steps a word."""
    rng = np.random.default_rng(1000 + seed)
    return np.sort(rng.choice(2 * n_words, size=min(sample, 2 * n_words), replace=False))


def sketches(tokens: np.ndarray, starts: np.ndarray, stops: np.ndarray, n_words: int, repeats: int) -> np.ndarray:
    """Bit samples of the embeddings, as 64-bit hashes: a row for each repetition."""
    chosen = [sample_steps(n_words, SAMPLE, r) for r in range(repeats)]
    needed = np.array([c[-1] + 1 for c in chosen])
    seeds = np.argsort(-needed, kind="stable")  # walks end after their last sample, the longest is first
    at_step: dict[int, list[int]] = {}
    for place, seed in enumerate(seeds.tolist()):
        for k in chosen[seed].tolist():
            at_step.setdefault(k, []).append(place)
    out = np.tile(at.random_words(repeats, 200)[:, None], (1, len(starts)))
    for k, here in enumerate(walk(tokens, starts, stops, needed[seeds], seeds)):
        if k in at_step:
            now = seeds[at_step[k]]
            out[now] = at.mixed(out[now] * np.uint64(0xD6E8FEB86659FD93) ^ here[at_step[k]])
    return out


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance between the item and any run of words of the text: (distance, first, end).

    Among equals the run that ends first, then the longest.
    """
    n = len(item)
    row, origin = np.arange(n + 1), np.zeros(n + 1, np.int64)
    best = (n, 0, 0)
    ramp = np.arange(n + 1)
    for j, word in enumerate(text):
        change = row[:-1] + (item != word)
        drop = row[1:] + 1
        new = np.concatenate([[0], np.minimum(change, drop)])
        came = np.concatenate([[j + 1], np.where(change <= drop, origin[:-1], origin[1:])])
        # a word of the item left out: the running minimum of new - ramp
        low = np.minimum.accumulate(new - ramp)
        take = np.maximum.accumulate(np.where(new - ramp == low, ramp, 0))
        row, origin = low + ramp, came[take]
        if row[-1] < best[0]:
            best = (int(row[-1]), int(origin[-1]), j + 1)
    return best


@dataclass
class Items:
    """A block of benchmark items, ready to be looked for."""

    ids: list
    words: list[np.ndarray]
    allowed: np.ndarray
    triples: np.ndarray  # of all items, sorted
    own_triples: np.ndarray  # item * len(triples) + place in triples, sorted
    needed: np.ndarray  # word triples that each item's nearest windows share with it at least
    part_item: np.ndarray  # of each part, its item and the words before it
    part_offset: np.ndarray
    slack: np.ndarray  # words by which a part of an item may be found beside its place, 0 for an item in one part
    classes: list[tuple[int, int, int, int, list[tuple[np.ndarray, np.ndarray]]]]
    # each length class of parts: least and most words, window words, triples needed, and sketches of every repetition


def _length_classes(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Parts whose lengths differ by an eighth at most, the shortest class first."""
    order = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(order):
        last = int(np.searchsorted(lengths[order], lengths[order[first]] * 9 // 8, side="right"))
        yield order[first:last]
        first = last


def prepare(ids: list, texts: list[str], max_edits: float, recall: float) -> Items:
    data, offsets = at.flat(pc.utf8_lower(pa.array(texts, pa.string())))
    w = at.words(data, offsets)
    cut = [w.hashes[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    some = [k for k, x in enumerate(cut) if len(x)]
    ids, cut = [ids[k] for k in some], [cut[k] for k in some]
    lengths = np.array([len(x) for x in cut], np.int64)
    allowed = np.floor(max_edits * lengths + 1e-9).astype(np.int64)
    hashes, bounds = at.windows(w, Q)
    triples, place = np.unique(hashes, return_inverse=True)
    owner = np.repeat(np.cumsum(np.diff(bounds) > 0) - 1, np.diff(bounds))
    own = np.unique(owner * len(triples) + place)
    needed = np.maximum(lengths - Q + 1 - Q * allowed, 0)
    tokens = np.concatenate(cut) if cut else np.zeros(0, np.uint64)
    n_parts = -(-lengths // LONGEST)
    item = np.repeat(np.arange(len(lengths)), n_parts)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts)
    offset = lengths[item] * nth // n_parts[item]
    size = lengths[item] * (nth + 1) // n_parts[item] - offset
    edits = np.floor(max_edits * size + 1e-9).astype(np.int64)
    begins = (np.cumsum(lengths) - lengths)[item] + offset
    slack = np.zeros(len(lengths), np.int64)
    np.maximum.at(slack, item, np.where(n_parts[item] > 1, edits, 0))
    classes = []
    for group in _length_classes(size):
        least, most = int(size[group].min()), int(size[group].max())
        need = int(np.maximum(size[group] - Q + 1 - Q * edits[group], 0).min())
        tables = []
        for h in sketches(tokens, begins[group], begins[group] + least, least, repetitions(recall)):
            order = np.argsort(h, kind="stable")
            tables.append((h[order], group[order]))
        classes.append((least, most, most + int(edits[group].max()), need, tables))
    return Items(ids, cut, allowed, triples, own, needed, item, offset, slack, classes)


def find(items: Items, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(row, item, distance, first word, end word) of the best match of each row and item."""
    data, offsets = at.flat(pc.utf8_lower(texts))
    w = at.words(data, offsets)
    n = len(w.hashes)
    if not n or not items.ids:
        return []
    hashes, bounds = at.windows(w, Q)
    known = np.zeros(n + 1, np.int64)
    place = np.searchsorted(items.triples, hashes)
    hit = items.triples[np.minimum(place, len(items.triples) - 1)] == hashes
    # the k-th window of a text starts at its k-th word
    rows = at.row_of(bounds)
    at_word = w.bounds[:-1][rows] + np.arange(len(hashes)) - bounds[:-1][rows]
    known[1 + at_word] = hit
    triple = np.full(n, -1, np.int64)
    triple[at_word[hit]] = place[hit]
    known = np.cumsum(known)
    if not known[-1] and items.needed.min() > 0:
        return []
    stop = np.repeat(w.bounds[1:], np.diff(w.bounds))
    # few words have enough known triples in reach; only those are looked at for each length class
    reach = max(size for _, _, size, _, _ in items.classes)
    least_need = min(need for _, _, _, need, _ in items.classes)
    every = np.flatnonzero(known[np.minimum(np.arange(n) + reach, n)] - known[:n] >= least_need)
    row = w.texts()
    n_parts = len(items.part_item)
    pairs = [np.zeros(0, np.int64)]
    for least, _, size, need, tables in items.classes:
        end = np.minimum(every + size, stop[every])
        starts = every[known[end] - known[every] >= need]
        if not len(starts):
            continue
        sampled = sketches(w.hashes, starts, np.minimum(starts + least, stop[starts]), least, len(tables))
        for h, (keys, owners) in zip(sampled, tables, strict=True):
            lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            which = np.repeat(np.arange(len(h)), hi - lo)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
            pairs.append(starts[which] * n_parts + owners[lo[which] + nth])
    start, part = np.divmod(np.unique(np.concatenate(pairs)), n_parts)
    first, item = start - items.part_offset[part], items.part_item[part]
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, i, a, b in _spans(items, first, item, row[start], w.bounds, triple):
        d, begin, end = best_match(items.words[i], w.hashes[a:b])
        if d <= items.allowed[i] and ((text, i) not in out or d < out[text, i][0]):
            out[text, i] = (d, a + begin - int(w.bounds[text]), a + end - int(w.bounds[text]))
    return sorted((*pair, *best) for pair, best in out.items())


def _spans(
    items: Items, first: np.ndarray, item: np.ndarray, text: np.ndarray, bounds: np.ndarray, triple: np.ndarray
) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, begin, end) around candidate windows, overlapping ones made one, in order.

    Only spans with as many of the item's triples as a match must hold.
    """
    if not len(first):
        return
    order = np.lexsort((first, item, text))
    first, item, text = first[order], item[order], text[order]
    reach = items.allowed[item] + items.slack[item]
    length = np.array([len(x) for x in items.words], np.int64)[item]
    a, b = np.maximum(first - reach, bounds[text]), np.minimum(first + length + reach, bounds[text + 1])
    # in a text, the spans of one item begin and end in the same order
    fresh = np.ones(len(a), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (a[1:] > b[:-1])
    begins = np.flatnonzero(fresh)
    text, item, a, b = text[begins], item[begins], a[begins], b[np.append(begins[1:], len(b)) - 1]
    size = np.maximum(b - a - Q + 1, 1)
    done = np.cumsum(size)
    low = 0
    while low < len(a):  # about a million words at a time
        high = max(low + 1, int(np.searchsorted(done, done[low] + (1 << 20))))
        span = np.repeat(np.arange(low, high), size[low:high])
        place = triple[a[span] + np.arange(len(span)) - (done[span] - size[span] - (done[low] - size[low]))]
        span, place = span[place >= 0], place[place >= 0]
        code = item[span] * len(items.triples) + place
        own = items.own_triples[np.minimum(np.searchsorted(items.own_triples, code), len(items.own_triples) - 1)] == code
        shared = np.bincount(span[own] - low, minlength=high - low)
        for k in low + np.flatnonzero(shared >= items.needed[item[low:high]]):
            yield int(text[k]), int(item[k]), int(a[k]), int(b[k])
        low = high


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of at most ``limit`` bytes of text, or one item; the driver holds one block."""
    ids, texts, size = [], [], 0
    source = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).alias("i"), F.col(text).alias("t"))
    for row in source.distinct().orderBy("i", "t").toLocalIterator():
        if ids and size + len(row.t) > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += len(row.t)
    if ids:
        yield ids, texts


def find_passages(
    documents: DataFrame,
    benchmark: DataFrame,
    max_edits: float = MAX_EDITS,
    recall: float = RECALL,
    block_bytes: int = BLOCK_BYTES,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Benchmark items found in documents: (doc_id, item_id, distance, first_word, end_word).

    One row for each pair of a document row and an item of which some run of words has an edit
    distance of at most ``max_edits`` times the item's words; the nearest run, the first among
    equals. Words are runs of ASCII letters, digits and non-ASCII characters, in lower case.

    A null or empty text, and an item without words, match nothing. A null doc_id or item_id is
    carried as it is. Repeated rows each give their own rows; equal items are looked for once.
    Other columns are ignored. An empty table on either side gives an empty table.
    """
    spark: SparkSession = documents.sparkSession
    source = documents.select(F.col(doc_id).alias("d"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = [source.schema["d"].dataType, benchmark.schema[item_id].dataType]
    long = StructType.fromDDL("distance long, first_word long, end_word long")
    schema = StructType([StructField(doc_id, kinds[0]), StructField(item_id, kinds[1]), *long])
    out = None
    for ids, texts in _blocks(benchmark, item_id, item_text, block_bytes):
        shared = spark.sparkContext.broadcast(prepare(ids, texts, max_edits, recall))
        found = source.mapInArrow(_finder(shared, doc_id, item_id, to_arrow_type(kinds[1])), schema)
        out = found if out is None else out.unionByName(found)
    # rows from a list are read by Python workers of their own, also if there are none
    return spark.createDataFrame([], schema) if out is None else out


def _finder(shared, doc_id: str, item_id: str, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in at.chunks(batches, limit=CHUNK_BYTES):
            found = find(items, batch.column("text"))
            rows, owners, *rest = zip(*found, strict=True) if found else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("d").take(pa.array(rows, pa.int64())),
                    pa.array([items.ids[k] for k in owners], kind),
                    *[pa.array(x, pa.int64()) for x in rest],
                ],
                [doc_id, item_id, "distance", "first_word", "end_word"],
            )

    return run


def clean_documents(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents in which no benchmark item is found; all their columns.

    Rows that share a doc_id go or stay together; rows with a null doc_id likewise.
    """
    found = find_passages(documents, benchmark, doc_id=doc_id, **options).select(F.col(doc_id).alias("__found")).distinct()
    found = materialise(found, "found")  # few: with their size known, Spark need not shuffle the texts
    return documents.join(found, documents[doc_id].eqNullSafe(found["__found"]), "left_anti")
