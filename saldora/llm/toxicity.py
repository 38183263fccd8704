"""Toxicity scores by non-negative positive-unlabelled learning.

Positives are confirmed toxic documents, everything else is unlabelled text. A linear
classifier in numpy minimises the non-negative estimate of the risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

where ``prior`` is the toxic share among the labelled rows that may be learnt from. Its
inputs are the presence of selected lower-case words and word beginnings, hashed to
``Bounds.hashed`` numbers; a document's features come from its whole text.

Bounds: at most ``positives`` confirmed and ``unlabelled`` other documents are fitted on,
chosen by key hash; at most ``selected`` features enter the model, those that set the
confirmed documents apart most clearly from the unlabelled ones. They are counted and chosen
in Spark; the driver gets the chosen features of the sampled documents only, so what it holds
is bounded by ``(positives + unlabelled) * selected``, however long the texts are.

Cases: a null or empty text has no features and scores as such. Labels that are null are
ignored; of several labels of one id the largest counts. Without any confirmed document
every score is 0. Repeated rows give repeated results; a null id is scored but not held
out and never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import first_by_hash
from saldora.llm.textbytes import byte_table, slices, span_hashes, words
from saldora.llm.textbytes import _BYTE_CODE
from saldora.session import local_frame, materialise

THRESHOLD = 0.7
# standard errors by which a feature must be commoner among the confirmed: chance alone
# brings about one of a quarter million hashed features there
CLEAR = 4.5
SCHEMA = "doc_id long, score double"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = byte_table(bytes(b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)))
_BEGINNINGS = (4, 5)


@dataclass(frozen=True)
class Bounds:
    positives: int = 3_000
    unlabelled: int = 8_000
    hashed: int = 1 << 18
    selected: int = 1_500
    steps: int = 600
    batch: int = 512


@dataclass
class Classifier:
    """``slot[hash]`` is a feature's place or -1; score = sigmoid(scale * z + shift)."""

    slot: np.ndarray
    weight: np.ndarray
    scale: float
    shift: float


def features(data: np.ndarray, offsets: np.ndarray, hashed: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hashed feature) of every word and of the beginnings of longer words."""
    lower = _LOWER[data]
    starts, ends, _ = words(lower, offsets, _WORD)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    codes = _BYTE_CODE[lower]
    found, owners = [span_hashes(codes, starts, ends)], [owner]
    for n in _BEGINNINGS:
        longer = np.flatnonzero(ends - starts > n)
        # another base than whole words: a beginning is not the short word it spells
        found.append(span_hashes(codes, starts[longer], starts[longer] + n, 0xC2B2AE3D27D4EB4F))
        owners.append(owner[longer])
    index = (np.concatenate(found) >> np.uint64(20)) & np.uint64(hashed - 1)
    return np.concatenate(owners), index.astype(np.int64)


# ------------------------------------------------------------------ fitting


def _dense(lists: list[np.ndarray], columns: int) -> np.ndarray:
    """One byte a cell; products are taken of a batch at a time."""
    out = np.zeros((len(lists), columns), dtype=np.uint8)
    for i, own in enumerate(lists):
        out[i, own] = 1
    return out


def _margins(x: np.ndarray, w: np.ndarray, step: int = 512) -> np.ndarray:
    parts = [x[at : at + step].astype(np.float32) @ w[:-1] for at in range(0, len(x), step)]
    return (np.concatenate(parts) if parts else np.zeros(0)) + w[-1]


def _log1pexp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def nn_pu_weights(
    pos: np.ndarray, unl: np.ndarray, prior: float, steps: int, batch: int, decay: float = 1e-3
) -> np.ndarray:
    """Weights and bias that minimise the non-negative risk with the logistic loss."""
    draw = np.random.default_rng(5)
    w = np.zeros(pos.shape[1] + 1, dtype=np.float64)
    m, v = np.zeros_like(w), np.zeros_like(w)

    def side(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = x @ w[:-1] + w[-1]
        return z, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(x: np.ndarray, out: np.ndarray) -> np.ndarray:
        return np.append(x.T @ out, out.sum()) / max(1, len(out))

    for step in range(1, steps + 1):
        p = pos[draw.integers(0, len(pos), batch)].astype(np.float32)
        u = unl[draw.integers(0, len(unl), batch)].astype(np.float32)
        z_p, s_p = side(p)
        z_u, s_u = side(u)
        excess = _log1pexp(z_u).mean() - prior * _log1pexp(z_p).mean()
        negative = gradient(u, s_u) - prior * gradient(p, s_p)
        if excess >= 0:
            grad = prior * gradient(p, s_p - 1) + negative
        else:  # the estimate fell below zero: walk back along it
            grad = -negative
        grad[:-1] += decay * w[:-1]
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def best_cut(pos: np.ndarray, unl: np.ndarray, prior: float) -> float:
    """Margin with the least non-negative 0-1 risk; the middle of the best range."""
    cuts = np.unique(np.concatenate([pos, unl]))
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    missed = np.searchsorted(np.sort(pos), cuts) / len(pos)
    above = 1 - np.searchsorted(np.sort(unl), cuts) / len(unl)
    risk = prior * missed + np.maximum(0, above - prior * (1 - missed))
    best = np.flatnonzero(risk <= risk.min() + 1e-9)
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def fit(
    pos: list[np.ndarray], unl: list[np.ndarray], apart: list[np.ndarray], chosen: np.ndarray,
    prior: float, bounds: Bounds,
) -> Classifier:
    """Fit on what ``apart`` leaves of both samples, place the cut on what it sets apart.

    ``pos`` and ``unl`` hold the places of each document's features in ``chosen``.
    """
    slot = np.full(bounds.hashed, -1, dtype=np.int32)
    if not pos or not unl:
        return Classifier(slot, np.zeros(1), 0.0, -50.0)
    slot[chosen] = np.arange(len(chosen))
    fitted, checked = [], []
    for own, out in zip((pos, unl), apart):
        fitted.append(_dense([x for x, o in zip(own, out) if not o], len(chosen)))
        checked.append(_dense([x for x, o in zip(own, out) if o] or own, len(chosen)))
    w = nn_pu_weights(fitted[0], fitted[1], prior, bounds.steps, bounds.batch)
    margins = [_margins(x, w) for x in checked]
    cut = best_cut(margins[0], margins[1], prior)
    spread = float(np.std(np.concatenate(margins))) or 1.0
    scale = 4.0 / spread
    return Classifier(slot, w, scale, -scale * cut + float(np.log(THRESHOLD / (1 - THRESHOLD))))


def select_features(sample: DataFrame, p: int, u: int, bounds: Bounds) -> np.ndarray:
    """Hashed features that are clearly commoner among the confirmed documents, best first.

    ``sample`` has confirmed, other (booleans: fitted on as such) and found, the distinct
    features of a document; ``p`` confirmed and ``u`` other documents are fitted on.
    """
    counts = sample.where("confirmed or other").select("confirmed", "other", F.explode("found").alias("feature"))
    counts = counts.groupBy("feature").agg(F.count_if("confirmed").alias("n_p"), F.count_if("other").alias("n_u"))
    share = (F.col("n_p") + F.col("n_u")) / float(p + u)
    gap = F.col("n_p") / float(p) - F.col("n_u") / float(u)
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / p + 1 / u))
    clear = CLEAR if min(p, u) >= 50 else 0.0
    best = counts.select("feature", "n_p", gap.alias("gap"), (gap / error).alias("z"))
    best = best.orderBy(F.desc("z"), "feature").limit(bounds.selected)
    chosen = best.where((F.col("z") >= clear) & (F.col("n_p") >= min(3, p)) & (F.col("gap") > 0))
    chosen = chosen.orderBy(F.desc("z"), "feature")
    return np.array([r["feature"] for r in chosen.collect()], dtype=np.int64)


def train(
    docs: DataFrame, labels: DataFrame, learnable: Column, bounds: Bounds = Bounds()
) -> Classifier:
    """Classifier from the ``learnable`` ids of ``labels`` and unlabelled ``docs``."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(learnable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    total, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    if not toxic:
        return fit([], [], [], np.zeros(0, np.int64), 0.0, bounds)
    confirmed = first_by_hash(known.where("toxic = 1").select("doc_id"), bounds.positives)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        learnable & F.col("doc_id").isNotNull()
    )
    others = first_by_hash(texts.select("doc_id").distinct(), bounds.unlabelled)
    wanted = (
        confirmed.withColumn("kind", F.lit(1))
        .unionByName(others.withColumn("kind", F.lit(0)))
        .groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))  # one or two kinds
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            owner, index = features(data, offsets, bounds.hashed)
            at = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[at], np.arange(rows.num_rows + 1))
            lists = [np.unique(index[at[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(lists, pa.list_(pa.int64()))],
                names=["doc_id", "kinds", "found"],
            )

    sample = materialise(
        texts.join(F.broadcast(wanted), "doc_id").select("doc_id", "kinds", "text")
        .mapInArrow(run, "doc_id long, kinds array<int>, found array<long>")
        .groupBy("doc_id").agg(F.min("kinds").alias("kinds"), F.min("found").alias("found"))
        .select("doc_id", "kinds", F.col("found").cast("array<int>").alias("found"))
    )
    # of each kind every fourth document places the cut; the ids are as bounded as the sample
    ids = sample.select("doc_id", "kinds").toArrow().sort_by("doc_id").to_pylist()
    lists = [[r["doc_id"] for r in ids if k in r["kinds"]] for k in (1, 0)]
    if not all(lists):
        return fit([], [], [], np.zeros(0, np.int64), 0.0, bounds)
    # a sample too small to be parted is used for both
    parted = min(map(len, lists)) >= 8
    apart = [np.arange(len(x)) % 4 == 0 if parted else np.zeros(len(x), dtype=bool) for x in lists]
    fitted = [[i for i, out in zip(x, o) if not out] for x, o in zip(lists, apart)]
    marked = local_frame(
        docs.sparkSession, [(i, i in p, i in u) for p, u in [map(set, fitted)] for i in sorted(p | u)],
        "doc_id long, confirmed boolean, other boolean",
    )
    chosen = select_features(
        sample.join(F.broadcast(marked), "doc_id"), len(fitted[0]), len(fitted[1]), bounds
    )
    slot = np.full(bounds.hashed, -1, dtype=np.int32)
    slot[chosen] = np.arange(len(chosen))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x[x >= 0] for x in (slot[f.values.to_numpy(zero_copy_only=False)] for f in batch["found"])]
            yield batch.set_column(1, "found", pa.array(own, pa.list_(pa.int32())))

    rows = sample.select("doc_id", "found").mapInArrow(places, "doc_id long, found array<int>").toArrow()
    found = {i: np.asarray(x.values, dtype=np.int16) for i, x in zip(rows["doc_id"].to_pylist(), rows["found"])}
    return fit(*[[found[i] for i in x] for x in lists], apart, chosen, toxic / total, bounds)


def scores(model: Classifier, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    owner, index = features(data, offsets, len(model.slot))
    places = model.slot[index]
    own = places >= 0
    width = len(model.weight)
    once = np.unique(owner[own] * width + places[own])
    z = np.bincount(once // width, model.weight[once % width], minlength=len(offsets) - 1)
    logit = model.scale * (z + model.weight[-1]) + model.shift
    return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id and score of every row; the model's size is fixed by ``Bounds``."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(**shared.value)
        for rows, data, offsets in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(scores(model, data, offsets), pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(**shared.value)
        for rows, data, offsets in slices(batches):
            yield rows.filter(pa.array(scores(model, data, offsets) < threshold))

    return docs.mapInArrow(run, docs.schema)
