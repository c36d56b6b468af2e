"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over windows of ``WINDOW`` bytes, each
filter's greatest response goes through a linear layer and a softmax. Training runs in numpy
on windows cut from at most ``TRAIN_ROWS`` labelled texts for each language. A text is cut
into windows from end to end, all of them are scored in batches, and its languages'
log-probabilities are averaged by the bytes that the windows hold.

Only text and label are used. Defined cases: a NULL text, and one without letters, is ``und`` with
score 0; so is every text when no labelled row is there to learn from. Other columns stay; own
columns replace columns of the same names; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.sampling import bounded_by_label, learnable
from strata.llm.textops import text_blocks

WINDOW = 256
#: Bound of labelled texts to learn from, for each language, and windows from each.
TRAIN_ROWS = 600
TRAIN_WINDOWS = 6
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDED = 6
EPOCHS = 6
UNKNOWN = "und"
_BATCH = 256

_LOWER = np.arange(256)
_LOWER[65:91] += 32


@dataclass
class Network:
    """Weights; the filters of all widths are one matrix, zero beyond their width."""

    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDED
    filters: np.ndarray  # (max width * EMBEDDED) x (FILTERS * widths)
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def mask() -> np.ndarray:
        rows = np.repeat(np.arange(max(WIDTHS)), EMBEDDED)
        return (rows[:, None] < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)

    def unfolded(self, windows: np.ndarray) -> np.ndarray:
        """Every run of the greatest width, embedded."""
        runs = np.lib.stride_tricks.sliding_window_view(self.embedding[windows].reshape(len(windows), -1), max(WIDTHS) * EMBEDDED, axis=1)
        return runs[:, ::EMBEDDED]

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        runs = np.ascontiguousarray(self.unfolded(windows)).reshape(-1, self.filters.shape[0])
        responses = (runs @ self.filters).reshape(len(windows), -1, self.filters.shape[1])
        return responses.max(axis=1) + self.filter_bias, responses, runs

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled, _, _ = self.pooled(windows)
        scores = np.maximum(pooled, 0) @ self.out + self.out_bias
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Fit by Adam on the cross-entropy; windows are shortened at random so that
    short texts are met in training too."""
    random = np.random.default_rng(seed)
    width, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = Network.mask()
    net = Network(
        languages,
        (random.standard_normal((256, EMBEDDED)) * 0.5).astype(np.float32),
        (random.standard_normal((width * EMBEDDED, filters)) * 0.3).astype(np.float32) * mask,
        np.zeros(filters, np.float32),
        (random.standard_normal((filters, len(languages))) * 0.2).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    names = ["embedding", "filters", "filter_bias", "out", "out_bias"]
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(windows))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            x = windows[pick].copy()
            if random.random() < 0.5:
                keep = (WINDOW ** random.uniform(0.5, 1.0, len(pick))).astype(int)
                x[np.arange(WINDOW)[None, :] >= keep[:, None]] = 0
            pooled, responses, runs = net.pooled(x)
            hidden = np.maximum(pooled, 0)
            scores = hidden @ net.out + net.out_bias
            odds = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(pick)), labels[pick]] -= 1
            error /= len(pick)
            back = (error @ net.out.T) * (pooled > 0)
            where = responses.argmax(axis=1)  # window x filter
            at_run = where + (np.arange(len(pick)) * responses.shape[1])[:, None]
            chosen = runs[at_run]  # window x filter x run
            grads = {
                "out": hidden.T @ error,
                "out_bias": error.sum(axis=0),
                "filter_bias": back.sum(axis=0),
                "filters": np.einsum("nf,nfd->df", back, chosen) * mask,
            }
            to_runs = back[:, :, None] * net.filters.T[None]  # window x filter x run
            embedded = np.zeros_like(net.embedding)
            for k in range(width):
                letters = x[np.arange(len(pick))[:, None], where + k]
                np.add.at(embedded, letters.ravel(), to_runs[:, :, k * EMBEDDED : (k + 1) * EMBEDDED].reshape(-1, EMBEDDED))
            grads["embedding"] = embedded
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(net, n, (getattr(net, n) - rate * first[n] / (np.sqrt(second[n]) + 1e-8)).astype(np.float32))
    return net


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows from end to end, the text and the number of bytes of each."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[:-1][text] + number * WINDOW
    held = np.minimum(WINDOW, offsets[1:][text] - start)
    padded = np.concatenate([_LOWER[data].astype(np.uint8), np.zeros(WINDOW, np.uint8)])
    windows = padded[start[:, None] + np.arange(WINDOW)[None, :]]
    windows[np.arange(WINDOW)[None, :] >= held[:, None]] = 0
    return windows, text, held


def _has_letters(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS) -> Network | None:
    """Learn from the labelled rows that are not held out; None where there are none."""
    usable = learnable(docs.select(key, text, label), key).where(F.col(label).isNotNull() & _has_letters(text))
    counts = {r[label]: r["n"] for r in usable.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    chosen = bounded_by_label(usable, label, counts, rows, text)
    schema = T.StructType([T.StructField("window", T.BinaryType()), T.StructField("label", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for row, _, data, offsets in text_blocks(batch.column(0)):
                windows, owner, _ = windows_of(data, offsets)
                firsts = np.searchsorted(owner, np.arange(len(offsets)))
                picks = []
                for a, b in zip(firsts, firsts[1:]):
                    picks.append(a + np.unique(np.linspace(0, max(b - a - 1, 0), TRAIN_WINDOWS).astype(int))[: b - a])
                picks = np.concatenate(picks).astype(int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([windows[p].tobytes() for p in picks], pa.binary()), pa.array([labels[row + owner[p]] for p in picks], pa.string())], schema.names
                )

    found = chosen.select(text, label).mapInArrow(cut, schema).collect()
    found.sort(key=lambda r: (r.label, bytes(r.window)))
    windows = np.frombuffer(b"".join(bytes(r.window) for r in found), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([languages.index(r.label) for r in found]), languages)


def predict(docs: DataFrame, network: Network | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Documents with ``lang_pred`` and ``score``."""
    own = ["lang_pred", "score"]
    kept = [c for c in docs.columns if c not in own and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            letters = batch.column(len(kept) + 1).to_numpy(zero_copy_only=False)
            for row, end, data, offsets in text_blocks(batch.column(len(kept))):
                count = end - row
                names, scores = np.full(count, UNKNOWN, object), np.zeros(count)
                if net is not None and len(data):
                    windows, owner, held = windows_of(data, offsets)
                    sums = np.zeros((count, len(net.languages)))
                    for at in range(0, len(windows), _BATCH):
                        part = slice(at, at + _BATCH)
                        np.add.at(sums, owner[part], net.log_probabilities(windows[part]) * held[part, None])
                    sums /= np.maximum(np.bincount(owner, held, count), 1)[:, None]
                    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                    odds /= odds.sum(axis=1, keepdims=True)
                    some = letters[row:end].astype(bool)
                    names[some] = np.array(net.languages, object)[odds.argmax(axis=1)][some]
                    scores[some] = odds.max(axis=1)[some]
                old = [batch.column(k).slice(row, count) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays(old + [pa.array(names, pa.string()), pa.array(scores)], schema.names)

    picked = [F.col(f"`{c}`") for c in kept] + [F.col(f"`{text}`").alias("__text"), _has_letters(text).alias("__letters")]
    return docs.select(*picked).mapInArrow(run, schema)
