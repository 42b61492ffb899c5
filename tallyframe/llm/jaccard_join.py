"""Similarity join on word shingles with Bayesian pruning of MinHash candidates.

1. Every row gets the set of its five-word shingles. Rows with equal sets are one class; the rest
   of the work is done once a class.
2. A class has a signature of MinHash values. Classes that agree on a band of it share a bucket.
3. In a bucket, signatures are compared a few values at a time. A pair is dropped as soon as the
   posterior probability that its similarity reaches the threshold falls below a tolerance. What
   survives leaves as a spanning forest of the bucket, not as pairs.
4. Connected survivors form a cluster. Only their texts are read again, and in each cluster the
   exact similarity of all members is computed in blocks. A block gives the number of links of
   each member and, again, a spanning forest of the links.
5. Connected links give the groups.

Hot buckets and clusters are cut into blocks of bounded size, and each pair of blocks is a task's
unit of work, so no group meets in one task and no pair of documents is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from . import arrow_text as at
from .components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
#: 40 bands of 4 values: a pair of similarity 0.8 shares no band with probability 1e-9.
BANDS, BAND_ROWS = 40, 4
N_HASHES = BANDS * BAND_ROWS
#: Values compared between two looks at the posterior, and the probability below which a pair goes.
STEP, TOLERANCE = 16, 1e-6
#: Members of a bucket or cluster in one block.
BUCKET_BLOCK, CLUSTER_BLOCK = 512, 256
#: Shingles of a block whose columns are multiplied at once.
COLUMNS = 4096


def minhash(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows of N_HASHES values of 16 bits; equal shingle sets have equal rows."""
    out = np.zeros((len(bounds) - 1, N_HASHES), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    odd = at.random_words(N_HASHES, 5) | np.uint64(1)
    shift = np.uint64(32)
    for k in range(N_HASHES):
        least = np.minimum.reduceat((shingles * odd[k] >> shift).astype(np.uint32), bounds[:-1][full])
        out[full, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def least_matches(threshold: float, tolerance: float, n_hashes: int = N_HASHES, step: int = STEP) -> list[int]:
    """For each look, the fewest equal values with which a pair is kept.

    With m of n values equal and a uniform prior, the posterior of the similarity is
    Beta(m + 1, n - m + 1), and its tail above ``threshold`` is a binomial sum.
    """
    out = []
    for n in range(step, n_hashes + 1, step):
        terms = [math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(n + 2)]
        m = 0
        while m < n and sum(terms[: m + 1]) < tolerance:
            m += 1
        out.append(m)
    return out


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and their bounds. Letters are compared in lower case."""
    data, offsets = at.flat(pc.utf8_lower(texts))
    hashes, bounds = at.windows(at.words(data, offsets), SHINGLE)
    rows = at.row_of(bounds)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[first], np.searchsorted(rows[first], np.arange(len(bounds)))


def _keys(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """16 bytes for each set: two independent sums of its shingles; null for an empty set."""
    a = at.reduced(np.add, at.mixed(hashes * np.uint64(0xD6E8FEB86659FD93)), bounds, 0)
    b = at.reduced(np.add, at.mixed(hashes ^ np.uint64(0xA0761D6478BD642F)), bounds, 0)
    keys = np.stack([a, b], 1)
    empty = np.diff(bounds) == 0
    return pa.array([None if e else k.tobytes() for k, e in zip(keys, empty, strict=True)], pa.binary())


def signatures(documents: DataFrame) -> DataFrame:
    """(id, digest, class_key, signature) of rows (id, text); the last two null for a text without words.

    The digest is a hash of the text, by which a class finds its own text again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            hashes, bounds = _sets(batch.column("text"))
            keys, values = _keys(hashes, bounds), minhash(hashes, bounds)
            signed = [v.tobytes() if k.is_valid else None for k, v in zip(keys, values, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), keys, pa.array(signed, pa.binary())],
                ["id", "digest", "class_key", "signature"],
            )

    source = documents.select("id", F.xxhash64("text").alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, digest long, class_key binary, signature binary")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Indices of links (a[i], b[i]) that connect what all of them connect: at most n - 1."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[y] = x
            kept.append(i)
    return np.array(kept, np.int64)


def survivors(left: np.ndarray, right: np.ndarray, least: list[int], band: int, same: bool):
    """Pairs (i, j) that no earlier band has in common and that Bayesian pruning keeps."""
    bits_left, bits_right = left.view(np.uint64), right.view(np.uint64)  # one number for a band
    open_ = np.ones((len(left), len(right)), bool)
    if same:
        open_ = np.triu(open_, 1)
    for k in range(band):
        open_ &= bits_left[:, k][:, None] != bits_right[:, k][None, :]
    i, j = np.nonzero(open_)
    equal = np.zeros(len(i), np.int64)
    for look, most in enumerate(least):
        span = slice(look * STEP, (look + 1) * STEP)
        for at_ in range(0, len(i), 1 << 16):  # bounded memory
            part = slice(at_, at_ + (1 << 16))
            equal[part] += (left[i[part], span] == right[j[part], span]).sum(1)
        stay = equal >= most
        i, j, equal = i[stay], j[stay], equal[stay]
    return i, j


def _blocks(members: DataFrame, group: str, item: str, size: int) -> DataFrame:
    """Members of each group with more than one, once for every pair of blocks they take part in.

    Adds ``p`` and ``q``, the blocks of the pair, and ``mine``, the member's own block. A group of
    n members has about n / size blocks, so a member is repeated that often.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("__n")).where("__n > 1")
    n = F.ceil(F.col("__n") / size)
    return (
        members.join(sizes, group)
        .withColumn("mine", F.pmod(F.xxhash64(item, F.lit(7)), n))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("p", F.least("mine", "other"))
        .withColumn("q", F.greatest("mine", "other"))
        .drop("__n", "other")
    )


def _two_sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
    mine = table.column("mine").to_numpy()
    left = np.flatnonzero(mine == p)
    return left, (left if p == q else np.flatnonzero(mine == q)), p == q


def candidates(classes: DataFrame, similarity: float, tolerance: float) -> DataFrame:
    """Links (a, b) between class keys: a spanning forest of the pairs that pruning keeps."""
    # the low bits of a bucket are its band; a short id of a class saves a third of the shuffle, and
    # should two classes ever share one, both come back for it
    bucket = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring("signature", k * (2 * BAND_ROWS) + 1, F.lit(2 * BAND_ROWS)))
        .bitwiseAND(F.lit(~63))
        .bitwiseOR(k),
    )
    short = classes.select(F.xxhash64("class_key").alias("short"), "class_key", "signature")
    rows = short.select("short", F.explode(bucket).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    held = materialise(rows.join(shared, "bucket"), "buckets")
    members = _blocks(held, "bucket", "short", BUCKET_BLOCK).join(short, "short")
    least = least_matches(similarity, tolerance)

    def run(table: pa.Table) -> pa.Table:
        left, right, same = _two_sides(table)
        keys = table.column("class_key").combine_chunks()
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, N_HASHES)
        i, j = survivors(signature[left], signature[right], least, table.column("bucket")[0].as_py() & 63, same)
        i, j = left[i], right[j]
        kept = _forest(i, j, len(keys))
        return pa.table({"a": keys.take(pa.array(i[kept])), "b": keys.take(pa.array(j[kept]))})

    return members.groupBy("bucket", "p", "q").applyInArrow(run, "a binary, b binary")


def _shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 blocks of bounded width."""
    both = np.zeros((len(left), len(right)), np.float32)
    column = np.unique(np.concatenate([sets[k] for k in np.union1d(left, right)]), return_inverse=False)
    places = {k: np.searchsorted(column, sets[k]) for k in np.union1d(left, right)}

    def side(rows: np.ndarray, first: int) -> np.ndarray:
        x = np.zeros((len(rows), min(COLUMNS, len(column) - first)), np.float32)
        for r, k in enumerate(rows):
            lo, hi = np.searchsorted(places[k], (first, first + COLUMNS))
            x[r, places[k][lo:hi] - first] = 1
        return x

    for first in range(0, len(column), COLUMNS):
        a = side(left, first)
        both += a @ (a if right is left else side(right, first)).T
    return both


def exact_links(members: DataFrame, similarity: float) -> DataFrame:
    """Rows (a, b, n): in each block, links of a spanning forest (n null), and the number of linked
    rows ``n`` of each member (b null)."""

    def run(table: pa.Table) -> pa.Table:
        left, right, same = _two_sides(table)
        if same:
            right = left
        keys = table.column("class_key").combine_chunks()
        copies = table.column("copies").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        if not len(left) or not len(right):
            return pa.table({"a": keys[:0], "b": keys[:0], "n": pa.array([], pa.int64())})
        both = _shared_counts(sets, left, right)
        total = size[left][:, None] + size[right][None, :] - both
        linked = both >= similarity * total - 1e-6
        if same:
            np.fill_diagonal(linked, False)
        i, j = np.nonzero(np.triu(linked, 1) if same else linked)
        kept = _forest(left[i], right[j], len(keys))
        who = left if same else np.concatenate([left, right])
        n = linked @ copies[right]
        n = n if same else np.concatenate([n, linked.T @ copies[left]])
        some = np.flatnonzero(n)
        none = pa.nulls(len(some), pa.binary())
        return pa.table(
            {
                "a": pa.concat_arrays([keys.take(pa.array(left[i[kept]])), keys.take(pa.array(who[some]))]),
                "b": pa.concat_arrays([keys.take(pa.array(right[j[kept]])), none]),
                "n": pa.concat_arrays([pa.nulls(len(kept), pa.int64()), pa.array(n[some].astype(np.int64))]),
            }
        )

    return members.groupBy("cluster", "p", "q").applyInArrow(run, "a binary, b binary, n long")


def _shingles_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class_key, shingles) of the wanted classes (class_key, first_id, digest), one row each.

    Texts are met by id and digest: rows of one id, or without one, meet only the class of their own
    text.
    """
    rows = documents.select("id", F.xxhash64("text").alias("row_digest"), "text")
    own = rows["id"].eqNullSafe(wanted["first_id"]) & (rows["row_digest"] == wanted["digest"])
    texts = rows.join(wanted, own).select("class_key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            hashes, bounds = _sets(batch.column("text"))
            keys = _keys(hashes, bounds)
            # should two texts of an id ever share a digest, only the class's own text stays
            same = pc.fill_null(pc.equal(keys, batch.column("class_key")), False).to_numpy(False)
            rows = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class_key").take(pa.array(rows)),
                    pa.array([hashes[bounds[r] : bounds[r + 1]].tobytes() for r in rows], pa.binary()),
                ],
                ["class_key", "shingles"],
            )

    return texts.mapInArrow(run, "class_key binary, shingles binary").dropDuplicates(["class_key"])


def jaccard_join(
    documents: DataFrame,
    similarity: float = SIMILARITY,
    tolerance: float = TOLERANCE,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row (doc_id, class_id, n_links, n_copies) per row of ``documents``.

    Two rows are linked if the Jaccard similarity of their sets of five-word shingles is at least
    ``similarity``. Words are runs of ASCII letters, digits and non-ASCII characters, in lower
    case; a text of fewer than five words is one shingle. ``class_id`` is the least doc_id of the
    row's group of connected rows, ``n_links`` the number of rows it is linked to, ``n_copies``
    the number of rows with the same shingles, itself included.

    Each row is a document: repeated rows are copies of each other. A text that is null or has no
    word is linked to nothing; its class is its own doc_id. A null doc_id sorts behind all others,
    so a group has a null class_id only if all its ids are null. Other columns are ignored.

    Candidates come from 40 bands of 4 MinHash values: a pair of similarity 0.8 is missed with
    probability 1e-9. Pruning loses a true pair with a probability of about ``tolerance`` at most.
    Everything that is kept is verified exactly.
    """
    source = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    signed = materialise(signatures(source), "signatures")
    classes = materialise(
        signed.where(F.col("class_key").isNotNull())
        .groupBy("class_key")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("least"),
            F.count("*").alias("copies"),
            F.first("signature").alias("signature"),
        )
        .select("class_key", F.col("least.id").alias("first_id"), "least.digest", "copies", "signature"),
        "classes",
    )
    near = connected_components(materialise(candidates(classes, similarity, tolerance), "candidates"))
    near = materialise(near.select(F.col("node").alias("class_key"), F.col("component").alias("cluster")), "clusters")
    light = classes.select("class_key", "first_id", "copies")
    members = near.join(classes.select("class_key", "first_id", "digest", "copies"), "class_key")
    shingles = _shingles_of(source, members.select("class_key", "first_id", "digest"))
    blocks = _blocks(members.select("class_key", "cluster", "copies").join(shingles, "class_key"),
                     "cluster", "class_key", CLUSTER_BLOCK)
    found = materialise(exact_links(blocks, similarity), "links")
    groups = connected_components(found.where(F.col("b").isNotNull()).select("a", "b"))
    least = (
        groups.select(F.col("node").alias("class_key"), "component")
        .join(light.select("class_key", "first_id"), "class_key")
    )
    group_id = least.groupBy("component").agg(F.min("first_id").alias("group_id"))
    counts = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("class_key")).agg(F.sum("n").alias("n"))
    grouped = least.join(group_id, "component").select("class_key", "group_id")
    linked = grouped.join(counts, "class_key", "left")
    result = light.join(linked, "class_key", "left").select(
        "class_key",
        F.coalesce("group_id", "first_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.col("copies").alias("n_copies"),
    )
    return signed.select("id", "class_key").join(result, "class_key", "left").select(
        F.col("id").alias(doc_id),
        F.when(F.col("class_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
    )
