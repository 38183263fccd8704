"""Quality by nearest-neighbour voting in a latent-semantic space.

A document's terms are the four-byte patterns of its writing (letters, capitals, digits,
spaces and each sign told apart), hashed to ``Bounds.terms`` numbers, and how often a word
follows itself or comes again, and its vocabulary: words in small letters without signs, and
runs of six bytes beyond ASCII, from the start of a character, for writing without spaces;
both are hashed to ``Bounds.words`` numbers of their own. Term weights are
``log(1 + count)`` times the inverse document frequency, counted over all documents; a truncated singular value decomposition of the labelled documents'
weights gives the latent directions. The labelled vectors are broadcast: at most
``Bounds.labelled`` rows of ``Bounds.rank`` numbers, whatever the size of the corpus. Every
document's cosines with all of them are computed exactly, a block of documents at a time;
its ``Bounds.neighbours`` nearest vote with weights that grow with similarity.

At most ``labelled`` rows are learnt from, chosen by key hash; a document's vector comes
from its whole text. The driver holds their terms packed and unpacks ``_BLOCK`` rows at a time.

Cases: an empty or null text has no direction and gets the mean label. Labels that are null
are ignored; of several labels of one id the smallest counts. Without labels every score is
0.5. Where more labelled vectors are equally near than votes are left, they share these votes
evenly, so copies with different labels count alike whatever their ids. Repeated rows give
repeated results; a null id is scored but never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import first_by_hash
from saldora.llm.textbytes import byte_table, mix, slices, word_hashes, words

THRESHOLD = 0.3
SCHEMA = "doc_id long, score double"


@dataclass(frozen=True)
class Bounds:
    labelled: int = 6_000
    terms: int = 1 << 11
    words: int = 1 << 12
    rank: int = 48
    neighbours: int = 15
    power: float = 4.0


@dataclass
class Space:
    """idf (terms), directions (terms x rank), labelled unit vectors (rows x rank), labels.

    The last ``words`` terms are those of the vocabulary.
    """

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float
    words: int


def _classes() -> np.ndarray:
    kind = np.arange(256, dtype=np.uint64)
    kind[97:123] = kind[128:] = 97
    kind[65:91] = 65
    kind[48:58] = 48
    kind[9] = 32
    return kind


_CLASS = _classes()
_SMALL = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
_LETTERS = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))
_RUN = 6
_DOCS = 256  # documents whose counts are held at once
_REPEATS = 16  # the last terms are kept for repeated words
_GAIN = 6.0
_BLOCK = 512  # labelled rows unpacked at once
_TIE = 1e-6  # similarities that differ by less are equal


def vocabulary_counts(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """(documents, size) of log(1 + count) of the hashed words and runs beyond ASCII."""
    n = len(offsets) - 1
    starts, ends, cut = words(data, offsets, _LETTERS)
    code = word_hashes(_SMALL[data], starts, ends)
    owner = np.repeat(np.arange(n), np.diff(cut))
    if len(data) >= _RUN and (data >= 128).any():
        before = np.concatenate([[0], np.cumsum(data >= 128)])
        at = np.flatnonzero((data[: 1 - _RUN] >= 192) & (before[_RUN:] - before[:-_RUN] == _RUN))
        whose = np.searchsorted(offsets, at, side="right") - 1
        own = at + _RUN <= offsets[whose + 1]
        code = np.concatenate([code, mix(word_hashes(data, at[own], at[own] + _RUN))])
        owner = np.concatenate([owner, whose[own]])
    flat = owner * size + (code % np.uint64(size)).astype(np.int64)
    return np.log1p(np.bincount(flat, minlength=n * size).reshape(n, size).astype(np.float32))


def term_counts(data: np.ndarray, offsets: np.ndarray, terms: int, n_words: int) -> np.ndarray:
    """(documents, terms + n_words) of log(1 + count)."""
    return np.hstack([shape_counts(data, offsets, terms), vocabulary_counts(data, offsets, n_words)])


def _counted(batches: Iterator[pa.RecordBatch], terms: int, n_words: int):
    """(rows, counts) of at most ``_DOCS`` documents at a time."""
    for rows, data, offsets in slices(batches):
        for at in range(0, rows.num_rows, _DOCS):
            own = offsets[at : at + _DOCS + 1]
            yield rows.slice(at, len(own) - 1), term_counts(data[own[0] : own[-1]], own - own[0], terms, n_words)


def shape_counts(data: np.ndarray, offsets: np.ndarray, terms: int) -> np.ndarray:
    """(documents, terms) of log(1 + count) of the patterns of the writing."""
    n = len(offsets) - 1
    kind = _CLASS[data]
    out = np.zeros((n, terms), dtype=np.float32)
    if len(kind) >= 4:
        gram = kind[:-3] | kind[1:-2] << np.uint64(8) | kind[2:-1] << np.uint64(16) | kind[3:] << np.uint64(24)
        index = (mix(gram) % np.uint64(terms - _REPEATS)).astype(np.int64)
        owner = np.repeat(np.arange(n), np.diff(offsets))
        whole = owner[:-3] == owner[3:]
        flat = owner[:-3][whole] * terms + index[whole]
        out += np.bincount(flat, minlength=n * terms).reshape(n, terms)
    starts, ends, cut = words(data, offsets)
    if len(starts):
        code = word_hashes(data, starts, ends)
        owner = np.repeat(np.arange(n), np.diff(cut))
        same = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
        size = np.maximum(1, np.diff(cut))
        again = np.bincount(owner[1:][same], minlength=n) / size
        level = np.minimum(_REPEATS - 1, (again * 4 * _REPEATS).astype(np.int64))
        rows = np.flatnonzero(again > 0)
        out = np.log1p(out)
        out[rows, terms - _REPEATS + level[rows]] = _GAIN
        return out
    return np.log1p(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Packed:
    """Rows of terms as places and values of what is not nought."""

    places: list[np.ndarray]
    values: list[np.ndarray]
    terms: int

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.places), self.terms

    def __getitem__(self, rows: slice) -> np.ndarray:
        out = np.zeros((len(self.places[rows]), self.terms), dtype=np.float32)
        for i, (at, x) in enumerate(zip(self.places[rows], self.values[rows])):
            out[i, at] = x
        return out


def latent_space(
    counts: np.ndarray | Packed, labels: np.ndarray, bounds: Bounds, found: tuple[int, np.ndarray] | None = None
) -> Space:
    """Directions by a randomised truncated decomposition of the weighted, unit-length rows.

    ``found``: the number of documents and how many have each term; if None, of ``counts``.
    """
    n, terms = counts.shape
    documents, having = found or (n, (counts > 0).sum(axis=0))
    idf = np.log((1 + documents) / (1 + having)).astype(np.float32) + np.float32(0.1)

    def times(basis: np.ndarray) -> np.ndarray:
        return np.concatenate([_unit(counts[at : at + _BLOCK] * idf) @ basis for at in range(0, n, _BLOCK)])

    def twice(basis: np.ndarray) -> np.ndarray:
        total = np.zeros(basis.shape, dtype=np.float32)
        for at in range(0, n, _BLOCK):
            x = _unit(counts[at : at + _BLOCK] * idf)
            total += x.T @ (x @ basis)
        return total

    rank = max(1, min(bounds.rank, n, terms))
    draw = np.random.default_rng(3)
    basis = twice(draw.standard_normal((terms, min(terms, rank + 8))).astype(np.float32))
    for _ in range(3):
        basis, _ = np.linalg.qr(twice(basis))
    _, _, inner = np.linalg.svd(times(basis), full_matrices=False)
    directions = (basis @ inner[:rank].T).astype(np.float32)
    return Space(idf, directions, _unit(times(directions)).astype(np.float32), labels, bounds.neighbours, bounds.power, bounds.words)


def project(space: Space, counts: np.ndarray) -> np.ndarray:
    return _unit(_unit(counts * space.idf) @ space.directions)


def votes(space: Space, vectors: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Similarity-weighted mean label of each vector's nearest labelled ones."""
    if not len(space.labels):
        return np.full(len(vectors), 0.5)
    k = min(space.neighbours, len(space.labels))
    cosine = vectors @ space.vectors.T
    n = cosine.shape[1]
    least = np.partition(cosine, n - k, axis=1)[:, n - k : n - k + 1]
    above, near = cosine > least + _TIE, cosine >= least - _TIE
    left = k - above.sum(axis=1)
    row, column = np.nonzero(near)
    tied = ~above[row, column]
    share = np.where(tied, (left / np.maximum(1, np.bincount(row, tied, len(vectors))))[row], 1.0)
    weight = share * (np.maximum(cosine[row, column], 0) ** space.power + 1e-9)
    score = np.bincount(row, weight * space.labels[column], len(vectors)) / np.bincount(row, weight, len(vectors))
    return np.where(empty, space.labels.mean(), score).clip(0, 1)


def document_frequencies(docs: DataFrame, bounds: Bounds) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that have each term, over all ``docs``."""
    size = bounds.terms + bounds.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        having = np.zeros(size + 1, dtype=np.int64)  # the last place counts documents
        for rows, counts in _counted(batches, bounds.terms, bounds.words):
            having[:size] += (counts > 0).sum(axis=0)
            having[size] += rows.num_rows
        at = np.flatnonzero(having)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(having[at])], names=["term", "n"])

    found = (
        docs.select("text").mapInArrow(run, "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    )
    having = np.zeros(size + 1, dtype=np.int64)
    having[found["term"].to_numpy()] = found["n"].to_numpy()
    return int(having[size]), having[:size]


def train(
    docs: DataFrame, labels: DataFrame, learnable: Column, bounds: Bounds = Bounds()
) -> Space:
    """Latent space and labelled vectors from the ``learnable`` ids of ``labels``."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(learnable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    wanted = first_by_hash(known, bounds.labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, counts in _counted(batches, bounds.terms, bounds.words):
            at = [np.flatnonzero(x).astype(np.uint16) for x in counts]
            packed = [p.tobytes() + x[p].astype(np.float16).tobytes() for p, x in zip(at, counts)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(packed, pa.binary())],
                names=["doc_id", "quality", "terms"],
            )

    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(wanted), "doc_id").select("doc_id", "quality", "text")
        .mapInArrow(run, "doc_id long, quality int, terms binary")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("terms").alias("terms"))
        .toArrow().sort_by("doc_id")
    )
    if not sample.num_rows:
        none = np.zeros((0, 1), dtype=np.float32)
        size = bounds.terms + bounds.words
        flat, idf = np.zeros((size, 1), dtype=np.float32), np.ones(size, np.float32)
        return Space(idf, flat, none, np.zeros(0), bounds.neighbours, bounds.power, bounds.words)
    both = [np.frombuffer(x.as_py(), dtype=np.uint16) for x in sample["terms"]]  # places, then values
    counts = Packed(
        [x[: len(x) // 2] for x in both], [x[len(x) // 2 :].view(np.float16) for x in both], bounds.terms + bounds.words
    )
    known = sample["quality"].to_numpy().astype(np.float64)
    return latent_space(counts, known, bounds, document_frequencies(docs, bounds))


def score(docs: DataFrame, space: Space) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(space))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Space(**shared.value)
        for rows, counts in _counted(batches, len(model.idf) - model.words, model.words):
            out = votes(model, project(model, counts), ~counts.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
