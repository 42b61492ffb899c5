"""Packs token sequences into windows by Karmarkar-Karp multiway differencing.

Documents are tokenised and packed where they are read, in blocks of a bounded number of pieces, so
nothing is shuffled. Full windows are cut off each document first; the remainders of a block are
cut to a quarter window at most and merged by differencing: the two partial partitions with the
greatest imbalance are joined so that the heavy windows of one meet the light windows of the other.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow_text as at

CAPACITY = 1024
END_ID = 0
BLOCK_PIECES = 2000
VOCABULARY = "byte_bpe_50k.json"


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece. Partial partitions are sorted arrays of (sum, set of pieces)."""
    parent = np.arange(len(lengths) + 1)
    heap = []
    for k in np.argsort(-lengths, kind="stable"):
        heap.append((-int(lengths[k]), int(k), np.array([lengths[k]]), np.array([k])))
    heapq.heapify(heap)
    chain: list[tuple[int, int]] = []
    while len(heap) > 1:
        _, k, sums, heads = heapq.heappop(heap)
        _, _, other, others = heapq.heappop(heap)
        # heaviest of one with lightest of the other; windows that are not listed are empty
        meet = max(0, len(sums) + len(other) - windows)
        a, b = len(sums) - meet, len(other) - meet
        met = sums[a:] + other[b:][::-1]
        chain.extend(zip(heads[a:].tolist(), others[b:][::-1].tolist(), strict=True))
        sums = np.concatenate([sums[:a], other[:b], met])
        heads = np.concatenate([heads[:a], others[:b], heads[a:]])
        order = np.argsort(-sums, kind="stable")
        sums, heads = sums[order], heads[order]
        least = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (least - int(sums[0]), k, sums, heads))
    for into, piece in reversed(chain):
        parent[piece] = parent[into]
    out = np.empty(len(lengths), np.int64)
    place = {int(h): w for w, h in enumerate(heap[0][3])} if heap else {}
    for piece in range(len(lengths)):
        out[piece] = place[int(parent[piece])]
    return out


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Windows of at most ``capacity``; their number rises by a part in 200 while one is too full."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        of = differencing(lengths, windows)
        if np.bincount(of, lengths).max(initial=0) <= capacity:
            return of
        windows += max(1, windows // 200)


def encoder(path: str):
    """A function from a text to its token ids, by the vocabulary file's byte-level BPE.

    The ranks are those of the given file; the BPE library used is several times as fast as the
    file's own one and gives the same ids (tested). A token that the file adds to its vocabulary has
    the file's id wherever its literal stands in a text, as in the file's own library.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    added = {token["content"]: token["id"] for token in content["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in content["added_tokens"]):
        raise ValueError(f"{path}: added tokens that take in what stands beside them are not supported")
    # the file writes the bytes that are not printable as the code points from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    vocabulary = content["model"]["vocab"]
    ranks = {bytes(byte[c] for c in piece): k for piece, k in vocabulary.items() if piece not in added}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        # the search for added tokens costs as much as a tenth of the encoding; few texts hold one
        return own.encode(text, allowed_special="all") if any(x in text for x in added) else own.encode_ordinary(text)

    return encode


def pack(
    documents: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    block_pieces: int = BLOCK_PIECES,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents.

    A document's tokens are its ids and END_ID. ``ids`` are the piece's, as little-endian unsigned
    32-bit numbers. Each id lies in one piece; pieces of a sequence follow each other without gaps
    from offset 0, and a sequence has at most ``capacity`` ids. A null or empty text is END_ID
    alone; repeated rows are packed each; a null doc_id is carried; other columns are ignored; an
    empty table gives no pieces. sequence_id is unique in one result.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    source = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    quarter = -(-capacity // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []  # doc_id, start, ids, doc_tokens

        def emitted(rows: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, total, seq, offset = zip(*rows, strict=True) if rows else [()] * 6
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, batch_type), pa.array(start, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
                    pa.array(total, pa.int64()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64()),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def packed() -> list[tuple]:
            nonlocal sequence, waiting
            lengths = np.array([len(x[2]) for x in waiting], np.int64)
            of = pack_lengths(lengths, capacity)
            rows, filled = [], {}
            for k in np.argsort(of, kind="stable"):
                w = int(of[k])
                rows.append((*waiting[k], sequence + w, filled.get(w, 0)))
                filled[w] = filled.get(w, 0) + int(lengths[k])
            sequence += int(of.max(initial=-1)) + 1
            waiting = []
            return rows

        batch_type = None
        for batch in at.chunks(batches):
            batch_type = batch.column("doc_id").type
            rows = []
            for doc, content in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(content), END_ID], "<u4")
                full = len(ids) // capacity * capacity
                for start in range(0, full, capacity):
                    rows.append((doc, start, ids[start : start + capacity], len(ids), sequence, 0))
                    sequence += 1
                for start in range(full, len(ids), quarter):
                    waiting.append((doc, start, ids[start : start + quarter], len(ids)))
                if len(waiting) >= block_pieces:
                    rows += packed()
            yield emitted(rows)
        if waiting:
            yield emitted(packed())

    return source.mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
