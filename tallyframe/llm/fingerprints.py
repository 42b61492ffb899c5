"""Quartile bucket digests: short fingerprints whose difference says how alike two texts are.

Every three neighbouring bytes of a text are hashed into one of BUCKETS counters. A bucket is
written as the quartile of the text's counters that its count lies in, two bits each, after one byte
for the logarithm of the length. Like texts fill the same buckets, so few codes differ; the
difference of two digests is bounded by what unrelated texts with as many codes of each kind would
show, and by a bounded part for the lengths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from . import arrow_text as at

BUCKETS = 512
#: Positions counted at a time, so that memory does not follow the longest text.
SLICE = 1 << 20
#: A step of the length code is a tenth more bytes. Each step apart takes LENGTH_COST off the
#: likeness, up to LENGTH_STEPS of them.
LENGTH_BASE, LENGTH_COST, LENGTH_STEPS = 1.1, 0.005, 40
#: Fixed value: an odd multiplier (2**32 over the golden ratio) that spreads triplets over buckets.
_SPREAD = np.uint32(2654435769)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: the length code, then the quartile (0 to 3) of every bucket.

    A count up to the first quartile is 0, up to the median 1, up to the third quartile 2. A text of
    fewer than three bytes has no triplets and zeros throughout.
    """
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    out = np.zeros((n, BUCKETS + 1), np.uint8)
    out[:, 0] = np.minimum(255, np.rint(np.log1p(sizes) / np.log(LENGTH_BASE)))
    counts = np.zeros(n * BUCKETS, np.int64)
    for first in range(0, len(data) - 2, SLICE):
        wide = data[first : first + SLICE + 2].astype(np.uint32)
        triplet = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        bucket = ((triplet + np.uint32(1)) * _SPREAD) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        row = np.searchsorted(offsets, np.arange(first, first + len(wide)), side="right") - 1
        whole = row[:-2] == row[2:]
        low = row[0]
        found = np.bincount((row[:-2][whole] - low) * BUCKETS + bucket[whole])
        counts[low * BUCKETS : low * BUCKETS + len(found)] += found
    counts = counts.reshape(n, BUCKETS)
    ordered = np.sort(counts, axis=1)
    for quarter in (1, 2, 3):
        out[:, 1:] += counts > ordered[:, quarter * BUCKETS // 4 - 1][:, None]
    return out


def packed(codes: np.ndarray) -> list[bytes]:
    """Digests as bytes: one of length, then four buckets in each."""
    four = codes[:, 1:].reshape(len(codes), -1, 4)
    quads = (four[:, :, 0] << 6) | (four[:, :, 1] << 4) | (four[:, :, 2] << 2) | four[:, :, 3]
    return [x.tobytes() for x in np.concatenate([codes[:, :1], quads], axis=1)]


def encoded(codes: np.ndarray) -> list[str]:
    """Digests as lower-case hex."""
    return [x.hex() for x in packed(codes)]


def decoded(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    four = np.stack([raw[1:] >> 6, raw[1:] >> 4 & 3, raw[1:] >> 2 & 3, raw[1:] & 3], axis=1)
    return np.concatenate([raw[:1], four.ravel()]).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for each pair of digests (rows of ``a`` and ``b``); 1 for equal ones.

    One minus the difference of the codes over the difference that unrelated texts with these
    numbers of codes would show on average, less the cost of the lengths.
    """
    x, y = a[:, 1:].astype(np.int16), b[:, 1:].astype(np.int16)
    difference = np.abs(x - y).sum(axis=1).astype(float)
    share = lambda codes: np.stack([(codes == k).mean(axis=1) for k in range(4)], axis=1)
    apart = np.abs(np.arange(4)[:, None] - np.arange(4))
    unrelated = BUCKETS * np.einsum("ni,ij,nj->n", share(x), apart, share(y))
    same = np.where(unrelated > 0, 1 - difference / np.maximum(unrelated, 1e-9), (difference == 0).astype(float))
    steps = np.minimum(np.abs(a[:, 0].astype(int) - b[:, 0].astype(int)), LENGTH_STEPS)
    return np.clip(same - LENGTH_COST * steps, 0.0, 1.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their ``fingerprint``; a column of that name is replaced. No shuffle."""
    documents = documents.drop("fingerprint")
    schema = at.schema_with(documents, "fingerprint string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches, text):
            found = encoded(digests(*at.flat(batch.column(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "fingerprint"])

    return documents.mapInArrow(run, schema)


#: Hashes and digests are written as bytes, half as long as in hex.
_RESULT = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _RESULT.split(", ")]
_KINDS = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _digests_of(texts: list[str]) -> np.ndarray:
    return digests(*at.flat(pa.array(texts, pa.large_string())))


def _compared(texts: list[str], codes: np.ndarray, following: list[str], next_codes: np.ndarray) -> list[pa.Array]:
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    edited_codes = _digests_of(changed)
    return [
        pa.array([len(x) for x in texts], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).digest() for x in changed], pa.binary()),
        pa.array(packed(codes), pa.binary()),
        pa.array(packed(edited_codes), pa.binary()),
        pa.array(likeness(codes, edited_codes), pa.float64()),
        pa.array(likeness(codes, next_codes), pa.float64()),
    ]


def compare_with_next(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the row's with its last half replaced by the beginning of the next row's, in
    the order of doc_id; after the last row comes the first. ``near_edited`` is the likeness of the
    row's fingerprint to the edited text's, ``near_next`` to the next row's.

    A null text counts as empty; empty texts have a fingerprint of zeros and are wholly alike. A null
    doc_id comes first. Rows that share an id follow each other by a hash of their texts, equal rows
    as they are stored; each is a document of its own. A single row is its own next one. Other columns
    are ignored. An empty table gives an empty one.

    Rows are dealt by ranges of the order, so an id on very many rows is many tasks. Within a range
    each row meets the next; the first and last rows of all ranges, two for each, are written beside
    the results and meet in a second step.
    """
    source = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = ["doc_id", "tie", "place"]
    kind = source.schema["doc_id"].dataType.simpleString()

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None

        def edge(name: str, doc: pa.Array, content: str) -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in _KINDS]
            arrays = [doc, *none, pa.array([name]), pa.array([part], pa.int32()), pa.array([content], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_NAMES, "edge", "part", "text"])

        for batch in at.chunks(batches):
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            codes = _digests_of(texts)
            if last is None:
                yield edge("first", ids.slice(0, 1), texts[0])
            else:
                ids = pa.concat_arrays([last[0], ids])
                texts, codes = [last[1], *texts], np.concatenate([last[2], codes])
            rows = len(texts) - 1
            if rows:
                found = _compared(texts[:-1], codes[:-1], texts[1:], codes[1:])
                arrays = [
                    ids.slice(0, rows), *found,
                    pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *_NAMES, "edge", "part", "text"])
            last = ids.slice(rows, 1), texts[-1], codes[-1:]
        if last is not None:
            yield edge("last", last[0], last[1])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in at.chunks(batches):
            texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
            found = _compared(texts, _digests_of(texts), following, _digests_of(following))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], ["doc_id", *_NAMES])

    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = materialise(
        ranged.mapInArrow(within, f"doc_id {kind}, {_RESULT}, edge string, part int, text string"), "fingerprints"
    )
    heads = rows.where("edge = 'first'").select("part", F.col("text").alias("following"))
    # one number for each range of the order, not for each row
    parts = sorted(r.part for r in heads.select("part").collect())
    ring = documents.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, then int")
    met = (
        rows.where("edge = 'last'").select("doc_id", "text", "part").join(ring, "part")
        .join(heads.withColumnRenamed("part", "then"), "then").select("doc_id", "text", "following")
    )
    out = rows.where("edge IS NULL").select("doc_id", *_NAMES).unionByName(met.mapInArrow(across, f"doc_id {kind}, {_RESULT}"))
    hexed = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return out.select("doc_id", *[F.lower(F.hex(c)).alias(c) if c in hexed else F.col(c) for c in _NAMES])
