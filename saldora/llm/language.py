"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time. It labels every byte
position of a text with a distribution over the learned languages; the distributions of
all positions are averaged into the document's.

Training sees at most ``TrainingBounds.documents`` documents with a language, drawn by key
hash, the same expected number of each language, and of each document stretches of ``width``
bytes, spread over its whole text: ``windows`` of them, of documents in rare languages up to
``most_windows``. Every step draws its batch evenly over the languages. At most ``languages``
of them are learned, the commonest ones.

Prediction reads every byte of every text, in stretches of ``width`` bytes that run through
the network side by side. The last stretch of a text is filled with zero bytes, so a result
depends on the text alone and not on its neighbours (up to the rounding of 32-bit sums).

Cases: null text and text without a letter are ``und`` with score 0. With no learned
language at all, every document is ``und``. Repeated rows give repeated results. A null id
is not held out. Equal probabilities go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import first_by_hash
from saldora.llm.textbytes import slices

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
SCHEMA = "doc_id long, lang_pred string, score double"


@dataclass(frozen=True)
class TrainingBounds:
    """What training may see and do; the sample's size is fixed by these numbers alone."""

    documents: int = 3_000
    windows: int = 4
    most_windows: int = 64
    width: int = 64
    languages: int = 500
    hidden: int = 8
    batch: int = 256
    steps: int = 500
    rate: float = 0.01


# ------------------------------------------------------------------ network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    """Two gated recurrent directions and one output layer.

    ``inputs[d]`` is 256 x 3h (a byte's contribution to update, reset and candidate),
    ``hidden[d]`` h x 3h, ``output`` 2h x languages.
    """

    inputs: list[np.ndarray]
    hidden: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray
    languages: list[str]
    width: int

    @classmethod
    def start(cls, languages: list[str], hidden: int, width: int) -> Network:
        draw = np.random.default_rng(7)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        return cls(
            [normal(256, 3 * hidden, scale=0.3) for _ in range(2)],
            [normal(hidden, 3 * hidden, scale=hidden**-0.5) for _ in range(2)],
            normal(2 * hidden, len(languages), scale=0.3),
            np.zeros(len(languages), dtype=np.float32),
            languages,
            width,
        )

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.hidden, self.output, self.bias]

    def states(self, seen: np.ndarray, direction: int, keep: list | None = None) -> np.ndarray:
        """Hidden states (width, rows, h) of byte rows (rows, width)."""
        rows, width = seen.shape
        h = self.hidden[direction].shape[0]
        table, recur = self.inputs[direction], self.hidden[direction]
        out = np.empty((width, rows, h), dtype=np.float32)
        state = np.zeros((rows, h), dtype=np.float32)
        order = range(width) if direction == 0 else range(width - 1, -1, -1)
        for t in order:
            x = table[seen[:, t]]
            back = state @ recur
            gates = _sigmoid(x[:, : 2 * h] + back[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(x[:, 2 * h :] + reset * back[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, update, reset, candidate, back[:, 2 * h :]))
            state = candidate + update * (state - candidate)
            out[t] = state
        return out

    def _run(self, columns: np.ndarray, direction: int) -> np.ndarray:
        """As ``states``, without what training keeps; ``columns`` is (width, rows)."""
        width, rows = columns.shape
        h = self.hidden[direction].shape[0]
        half = np.ones(3 * h, dtype=np.float32)
        half[: 2 * h] = 0.5  # a logistic gate is a tanh of half its input
        table, recur = self.inputs[direction] * half, self.hidden[direction] * half
        gate_in, cand_in = table[:, : 2 * h].copy(), table[:, 2 * h :].copy()
        gate_re, cand_re = recur[:, : 2 * h].copy(), recur[:, 2 * h :].copy()
        out = np.empty((width, rows, h), dtype=np.float32)
        gates, x = np.empty((rows, 2 * h), np.float32), np.empty((rows, 2 * h), np.float32)
        cand, y = np.empty((rows, h), np.float32), np.empty((rows, h), np.float32)
        state = np.zeros((rows, h), dtype=np.float32)
        for t in range(width) if direction == 0 else range(width - 1, -1, -1):
            np.matmul(state, gate_re, out=gates)
            np.take(gate_in, columns[t], axis=0, out=x, mode="clip")
            gates += x
            np.tanh(gates, out=gates)
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            np.matmul(state, cand_re, out=cand)
            cand *= gates[:, h:]
            np.take(cand_in, columns[t], axis=0, out=y, mode="clip")
            cand += y
            np.tanh(cand, out=cand)
            np.subtract(state, cand, out=y)
            y *= gates[:, :h]
            np.add(cand, y, out=out[t])
            state = out[t]
        return out

    def probabilities(self, columns: np.ndarray) -> np.ndarray:
        """(languages, width, rows): the distribution at every position of (width, rows) bytes."""
        width, rows = columns.shape
        h = self.hidden[0].shape[0]
        index = columns.astype(np.intp)
        logits = self.output[:h].T @ self._run(index, 0).reshape(-1, h).T
        logits += self.output[h:].T @ self._run(index, 1).reshape(-1, h).T
        logits += self.bias[:, None]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits.reshape(len(self.bias), width, rows)


def gradients(net: Network, seen: np.ndarray, mask: np.ndarray, label: np.ndarray):
    """Mean cross-entropy over the masked positions and its gradient for every weight."""
    rows, width = seen.shape
    h = net.hidden[0].shape[0]
    kept: list[list] = [[], []]
    hidden = np.concatenate([net.states(seen, d, kept[d]) for d in (0, 1)], axis=2)
    logits = hidden @ net.output + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    weight = (mask / max(1, mask.sum())).T[:, :, None].astype(np.float32)
    chosen = p[:, np.arange(rows), label]
    loss = float(-(np.log(chosen + 1e-9) * weight[:, :, 0]).sum())
    p[:, np.arange(rows), label] -= 1
    d_logits = p * weight
    d_output = np.tensordot(hidden, d_logits, axes=([0, 1], [0, 1]))
    d_bias = d_logits.sum(axis=(0, 1))
    d_hidden = d_logits @ net.output.T
    d_inputs, d_recurs = [], []
    for d in (0, 1):
        recur = net.hidden[d]
        d_table = np.zeros_like(net.inputs[d])
        d_recur = np.zeros_like(recur)
        carry = np.zeros((rows, h), dtype=np.float32)
        for t, before, update, reset, candidate, back in reversed(kept[d]):
            grad = d_hidden[t, :, d * h : (d + 1) * h] + carry
            d_candidate = grad * (1 - update) * (1 - candidate * candidate)
            d_update = grad * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * back * reset * (1 - reset)
            d_x = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            d_back = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
            d_recur += before.T @ d_back
            carry = grad * update + d_back @ recur.T
            hot = np.zeros((rows, 256), dtype=np.float32)
            hot[np.arange(rows), seen[:, t]] = 1
            d_table += hot.T @ d_x
        d_inputs.append(d_table)
        d_recurs.append(d_recur)
    return loss, [*d_inputs, *d_recurs, d_output, d_bias]


def fit(
    seen: np.ndarray, mask: np.ndarray, label: np.ndarray, languages: list[str], bounds: TrainingBounds
) -> Network:
    """Adam on batches of byte rows, drawn evenly over the languages."""
    net = Network.start(languages, bounds.hidden, bounds.width)
    if len(seen) == 0 or len(languages) < 2:
        return net
    draw = np.random.default_rng(11)
    by_label = np.argsort(label, kind="stable")
    present, begin, count = np.unique(label[by_label], return_index=True, return_counts=True)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, bounds.steps + 1):
        which = draw.integers(0, len(present), bounds.batch)
        pick = by_label[begin[which] + (draw.random(bounds.batch) * count[which]).astype(np.int64)]
        _, grads = gradients(net, seen[pick], mask[pick], label[pick])
        size = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        rate = bounds.rate * min(1.0, 2 * (1 - (step - 1) / bounds.steps))
        for w, g, m, v in zip(net.weights(), grads, first, second):
            g *= min(1.0, 1.0 / (size + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(
                np.float32
            )
    return net


# ------------------------------------------------------------------ training sample


def _cut(bounds: TrainingBounds):
    """Arrow task: the wanted number of stretches of each text, evenly spread over all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            ids, langs, parts = [], [], []
            for i in range(rows.num_rows):
                size = int(offsets[i + 1] - offsets[i])
                n = min(rows.column(3)[i].as_py(), -(-size // bounds.width))
                for k in range(n):
                    at = offsets[i] + (k * max(0, size - bounds.width)) // max(1, n - 1)
                    ids.append(rows.column(0)[i].as_py())
                    langs.append(rows.column(1)[i].as_py())
                    parts.append(data[at : min(at + bounds.width, offsets[i + 1])].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
                names=["doc_id", "lang", "part"],
            )

    return run


def _rows(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    seen = np.zeros((len(parts), width), dtype=np.uint8)
    mask = np.zeros((len(parts), width), dtype=bool)
    for i, part in enumerate(parts):
        seen[i, : len(part)] = np.frombuffer(part, dtype=np.uint8)
        mask[i, : len(part)] = True
    return seen, mask


def train(docs: DataFrame, learnable: Column, bounds: TrainingBounds = TrainingBounds()) -> Network:
    """Network for the languages of the ``learnable`` rows with a language."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("lang"),
        learnable.alias("use"),
    ).where("use and lang is not null and doc_id is not null and text is not null").drop("use")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(bounds.languages).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Network.start([], bounds.hidden, bounds.width)
    # the same expected number of documents of each language, and a bound for all of them;
    # where a language has fewer, each gives more stretches
    share = bounds.documents / len(languages)
    most = {
        r["lang"]: min(bounds.most_windows, bounds.windows * max(1, round(share / r["count"]))) for r in counts
    }
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, share / r["count"]))])
    windows = F.create_map(*[F.lit(x) for kv in most.items() for x in kv])
    draw = F.pmod(F.xxhash64(F.lit("lang"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    ids = first_by_hash(
        known.where(draw < F.try_element_at(rates, F.col("lang"))).select("doc_id").distinct(), bounds.documents
    )
    parts = (
        known.join(F.broadcast(ids), "doc_id").where(F.col("lang").isin(languages))
        .select("doc_id", "lang", "text", F.try_element_at(windows, F.col("lang")).alias("windows"))
        .mapInArrow(_cut(bounds), "doc_id long, lang string, part binary")
        .groupBy("doc_id", "part").agg(F.min("lang").alias("lang"))
        .withColumn("place", F.xxhash64("part", "doc_id"))
    )
    sample = (
        parts.orderBy("place", "doc_id", "part")
        .limit(2 * bounds.documents * bounds.windows)
        .collect()
    )
    seen, mask = _rows([bytes(r["part"]) for r in sample], bounds.width)
    label = np.array([languages.index(r["lang"]) for r in sample], dtype=np.int64)
    return fit(seen, mask, label, languages, bounds)


# ------------------------------------------------------------------ prediction


def document_probabilities(
    net: Network, data: np.ndarray, offsets: np.ndarray, batch: int = 2048
) -> np.ndarray:
    """Mean distribution over all positions, per document; zeros for an empty one."""
    width = net.width
    sizes = np.diff(offsets)
    pieces = -(-sizes // width)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = offsets[:-1][owner] + order * width
    length = np.minimum(width, offsets[1:][owner] - at)
    per_piece = np.zeros((len(net.languages), len(owner)))
    places = np.arange(width)[:, None]
    for k in range(0, len(owner), batch):
        part = slice(k, k + batch)
        inside = places < length[part]
        columns = np.zeros(inside.shape, dtype=np.uint8)  # zero beyond a document's end, as in training
        columns[inside] = data[(at[part] + places)[inside]]
        p = net.probabilities(columns)
        p *= inside
        per_piece[:, part] = p.sum(axis=1)
    total = np.stack([np.bincount(owner, row, minlength=len(sizes)) for row in per_piece], axis=1)
    return total / np.maximum(1, sizes)[:, None]


def has_letter(text: str) -> bool:
    found = _LETTER.search(text)  # also finds number signs such as a superscript two
    return found is not None and (found[0].isalpha() or any(c.isalpha() for c in text))


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred, score of every row. The network is a few kilobytes per language."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(**shared.value)
        for rows, data, offsets in slices(batches):
            best, score = [UNKNOWN] * rows.num_rows, [0.0] * rows.num_rows
            if model.languages:
                p = document_probabilities(model, data, offsets)
                for i, text in enumerate(rows.column(1)):
                    if has_letter(text.as_py() or ""):
                        k = int(p[i].argmax())
                        best[i], score[i] = model.languages[k], min(1.0, float(p[i, k]))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA)


def identify_language(
    docs: DataFrame, learnable: Column, bounds: TrainingBounds = TrainingBounds()
) -> DataFrame:
    """Train on the ``learnable`` rows of ``docs`` and predict for all of them."""
    return predict(docs, train(docs, learnable, bounds))
