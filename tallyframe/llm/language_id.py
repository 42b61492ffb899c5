"""Language identification by unigram pieces, summed over all segmentations.

A language gives each piece of a fixed public vocabulary a probability. A word is a sequence of
pieces, and its probability is the sum over all ways to cut it into pieces, by the forward
algorithm. A text's score under a language is the product over its words. The probabilities are
fitted by expectation maximisation on a bounded sample of labelled texts of each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dedup import top_k_per_group
from ..sources.tables import materialise
from . import arrow_text as at

#: Bounds of the sample that the model is fitted on: texts of a language, and their bytes; the text
#: that passes the second bound is the last.
N_LABELLED = 400
SAMPLE_BYTES = 16 << 20
ROUNDS = 4
VOCABULARY = "piece_bpe_32k.model"
UNKNOWN = "und"
CHUNK_BYTES = 4 << 20

LETTERS = np.zeros(256, bool)
LETTERS[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = True
_BYTE = at.random_words(256, 11)
_BASE = at.random_words(1, 12)[0] | np.uint64(1)
_BITS = 20


def pieces(path: str | None = None) -> list[bytes]:
    """All pieces of letters in the vocabulary, in lower case as the texts are; a space begins a word.

    Every single byte is a piece as well, so that all words have a segmentation.
    """
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if piece.removeprefix("▁").isalpha():
            found.add(piece.replace("▁", " ").lower().encode())
    return sorted(found)


@dataclass
class Lookup:
    """Ids of pieces by their hash."""

    keys: np.ndarray
    ids: np.ndarray
    seen: np.ndarray  # which leading bits of a hash any key has
    longest: int  # bytes of the longest piece

    @staticmethod
    def of(vocabulary: list[bytes]) -> Lookup:
        keys = np.zeros(len(vocabulary), np.uint64)
        for k, piece in enumerate(vocabulary):
            for b in piece:
                keys[k : k + 1] = keys[k : k + 1] * _BASE + _BYTE[b]
        keys = at.mixed(keys)
        order = np.argsort(keys)
        seen = np.zeros(1 << _BITS, bool)
        seen[keys >> np.uint64(64 - _BITS)] = True
        return Lookup(keys[order], order, seen, max(map(len, vocabulary)))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are pieces, and their ids."""
        hashes = at.mixed(hashes)
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _BITS)])
        at_ = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        true = self.keys[at_] == hashes[maybe]
        return maybe[true], self.ids[at_[true]]


def _padded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words grouped by length: their numbers, and their bytes behind a space."""
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        which = order[a:b]
        n = int(lengths[which[0]])
        for first in range(0, len(which), max(1, (1 << 20) // (n + 1))):
            part = which[first : first + max(1, (1 << 20) // (n + 1))]
            grid = np.full((len(part), n + 1), 32, np.uint8)
            grid[:, 1:] = data[starts[part][:, None] + np.arange(n)]
            yield part, grid


def _matches(grid: np.ndarray, lookup: Lookup) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
    """For every end position: (length, rows, piece ids) of the pieces that end there."""
    n = grid.shape[1]
    prefix = np.zeros((n + 1, len(grid)), np.uint64)
    for i in range(n):
        prefix[i + 1] = prefix[i] * _BASE + _BYTE[grid[:, i]]
    powers = np.cumprod(np.full(lookup.longest + 1, _BASE, np.uint64))
    out = []
    for i in range(1, n + 1):
        out.append([(k, *lookup.find(prefix[i] - prefix[i - k] * powers[k - 1])) for k in range(1, min(i, lookup.longest) + 1)])
    return out


def _forward(matches, n_rows: int, chances: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Scaled forward sums (rows x languages) at every position, and the logarithms taken out."""
    ahead = [np.ones((n_rows, chances.shape[1]))]
    logs = [np.zeros((n_rows, chances.shape[1]))]
    for i, ends in enumerate(matches, 1):
        total = np.zeros_like(ahead[0])
        top = logs[i - 1]
        for k, rows, ids in ends:
            scale = np.exp(logs[i - k][rows] - top[rows]) if k > 1 else 1.0
            total[rows] += ahead[i - k][rows] * scale * chances[ids]
        ahead.append(np.ones_like(total))
        logs.append(top + np.log(np.maximum(total, 1e-300)))
    return ahead, logs


def word_logs(data, starts, lengths, lookup: Lookup, chances: np.ndarray) -> np.ndarray:
    """log P(word | language) of each word, summed over all segmentations."""
    out = np.zeros((len(starts), chances.shape[1]))
    for part, grid in _padded(data, starts, lengths):
        out[part] = _forward(_matches(grid, lookup), len(part), chances)[1][-1]
    return out


def fit_language(texts: pa.Array, vocabulary: list[bytes], rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities by expectation maximisation over the distinct words of the texts."""
    lookup = Lookup.of(vocabulary)
    data, offsets = at.flat(pc.utf8_lower(texts))
    w = at.words(data, offsets, LETTERS)
    _, first, counts = np.unique(w.hashes, return_index=True, return_counts=True)
    starts, lengths = w.starts[first], (w.ends - w.starts)[first]
    chances = np.full((len(vocabulary), 1), 1 / len(vocabulary))
    for _ in range(rounds):
        expected = np.full(len(vocabulary), 0.01)
        for part, grid in _padded(data, starts, lengths):
            matches = _matches(grid, lookup)
            logs = [x[:, 0] for x in _forward(matches, len(part), chances)[1]]
            n = len(matches)
            back = [None] * n + [np.zeros(len(part))]
            for j in range(n - 1, -1, -1):
                back[j] = np.full(len(part), -np.inf)
                for i in range(j + 1, min(n, j + lookup.longest) + 1):
                    _, rows, ids = matches[i - 1][i - j - 1]
                    if len(rows):
                        back[j][rows] = np.logaddexp(back[j][rows], np.log(chances[ids, 0]) + back[i][rows])
            for i, ends in enumerate(matches, 1):
                for k, rows, ids in ends:
                    share = np.exp(logs[i - k][rows] + np.log(chances[ids, 0]) + back[i][rows] - logs[n][rows])
                    np.add.at(expected, ids, share * counts[part][rows])
        chances = (expected / expected.sum())[:, None]
    return chances[:, 0]


@dataclass
class Model:
    languages: list[str]
    vocabulary: list[bytes]
    chances: np.ndarray  # pieces x languages


def fit(labelled: DataFrame, n_labelled: int = N_LABELLED, path: str | None = None) -> Model:
    """Fits on rows (doc_id, text, lang); rows with a null lang or text are left out.

    ``n_labelled`` bounds the texts of a language: those first in the order of a hash of doc_id and
    text, and of these as many as SAMPLE_BYTES hold. Each language is fitted in a task of its own. The
    driver gets pieces x languages numbers; languages are a closed set of codes.

    The hash of the last text taken is found from hashes alone; rows up to it are then cut to
    ``n_labelled`` in each task before they are shuffled, so rows that share an id, or are equal, do
    not gather.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    placed = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("place"))
    first = top_k_per_group(placed.select("lang", "place"), ["lang"], [F.col("place")], n_labelled)
    limit = materialise(first.groupBy("lang").agg(F.max("place").alias("most")), "language-sample")
    near = placed.join(limit, "lang").where("place <= most").drop("most")
    chosen = top_k_per_group(near, ["lang"], [F.col("place")], n_labelled)
    before = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)) < SAMPLE_BYTES
    sample = chosen.withColumn("taken", taken).where("taken").select("lang", "text")
    vocabulary = pieces(path)

    def run(table: pa.Table) -> pa.Table:
        chances = fit_language(table.column("text").combine_chunks(), vocabulary)
        return pa.table({"lang": table.column("lang").slice(0, 1), "chances": pa.array([chances.tobytes()], pa.binary())})

    rows = sample.groupBy("lang").applyInArrow(run, "lang string, chances binary").collect()
    rows.sort(key=lambda r: r.lang)
    chances = [np.frombuffer(r.chances, np.float64) for r in rows]
    return Model([r.lang for r in rows], vocabulary, np.stack(chances, 1) if rows else np.zeros((len(vocabulary), 0)))


def identify(texts: pa.Array, model: Model, lookup: Lookup) -> tuple[list[str], np.ndarray]:
    n = len(texts)
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(False)
    data, offsets = at.flat(pc.utf8_lower(texts))
    w = at.words(data, offsets, LETTERS)
    totals = np.zeros((n, len(model.languages)))
    if len(w.hashes) and model.languages:
        _, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        logs = word_logs(data, w.starts[first], (w.ends - w.starts)[first], lookup, model.chances)
        rows = w.texts()
        for k in range(len(model.languages)):
            totals[:, k] = np.bincount(rows, logs[which, k], minlength=n)
    if not model.languages:
        return [UNKNOWN] * n, np.zeros(n)
    best = totals.argmax(1)
    share = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
    return names, np.where(letters, np.round(share, 6), 0.0)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` plus lang_pred and score, the posterior under equal priors.

    A text that is null or has no letter, and any text if no language was learned, gets ``und`` and
    score 0. Ties go to the language first in the alphabet. Repeated rows get equal results;
    columns named lang_pred or score are replaced; an empty table gives an empty one.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop("lang_pred", "score")
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lookup = Lookup.of(m.vocabulary)
        for batch in at.chunks(batches, limit=CHUNK_BYTES):
            found, score = identify(batch.column("text"), m, lookup)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"]
            )

    return documents.mapInArrow(run, at.schema_with(documents, "lang_pred string, score double"))
