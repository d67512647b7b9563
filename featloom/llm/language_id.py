"""Language identification with a byte-level convolutional network.

Filters of several widths run over the bytes of fixed-length windows, each
filter keeps its largest response in the window, and a softmax layer turns these
into language probabilities; a text's probabilities are the mean over its windows,
weighted by their letters. The network is trained in numpy on a bounded sample
of labelled rows and then applied to whole texts in batches of windows.

A filter over bytes is a sum of table look-ups (one row of weights for each byte and
offset). For prediction neighbouring offsets are folded into tables by byte pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks

UNDETERMINED = "und"
WIDTHS = (2, 3, 4)
_SCHEMA = "struct<lang_pred string, score double>"
_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
_LETTER = ((np.arange(256) | 32) >= 97) & ((np.arange(256) | 32) <= 122)
#: What the network sees: ASCII letters in lower case, bytes beyond ASCII, all else a blank.
_SEEN = np.where(np.arange(256) >= 128, np.arange(256), np.where(_LETTER, np.arange(256) | 32, 32)).astype(np.uint8)


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit.

    rows: most labelled rows that are used (those with the smallest hash of their id and text), each with all windows of its text; row_windows: windows of a
    row that an epoch draws, anew each time (all of them if it has no more); window: bytes in a window; filters: per width; epochs, batch,
    rate, decay: of the Adam optimiser.
    """

    rows: int = 6000
    row_windows: int = 6
    window: int = 128
    filters: int = 8
    epochs: int = 8
    batch: int = 256
    rate: float = 0.01
    decay: float = 1e-5
    seed: int = 7


@dataclass
class Network:
    labels: list[str]
    window: int
    tables: list[np.ndarray]  # by width: offset, byte, filter
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _softmax(np.maximum(self._pooled(windows) + self.bias, 0) @ self.out + self.out_bias)

    def _pooled(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        pooled = []
        for width, tables in zip(WIDTHS, self.by_pair()):
            n = windows.shape[1] - width + 1
            response = None
            for offset, table in tables:
                index = pairs[:, offset : offset + n] if table.shape[0] > 256 else windows[:, offset : offset + n]
                part = table.take(index, axis=0)
                response = part if response is None else np.add(response, part, out=response)
            pooled.append(response.max(axis=1))
        return np.concatenate(pooled, axis=1)

    def by_pair(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width (offset, table): two offsets in one table by byte pair, an odd last one by byte."""
        if not hasattr(self, "_pairs"):
            self._pairs = []
            for width, table in zip(WIDTHS, self.tables):
                own = [(o, (table[o][:, None] + table[o + 1][None]).reshape(65536, -1)) for o in range(0, width - 1, 2)]
                self._pairs.append(own + [(width - 1, table[width - 1])] * (width % 2))
        return self._pairs

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pairs"}


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive windows of each row, the last padded with blanks, and the row of each."""
    lengths = np.diff(offsets)
    count = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), count)
    flat = np.full(int(count.sum()) * size, 32, np.uint8)
    begin = np.concatenate([[0], np.cumsum(count)[:-1]]) * size
    flat[blocks.spread(begin, lengths)] = _SEEN[data]
    return flat.reshape(-1, size), row


def train(texts: list[str], labels: list[str], settings: Training = Training()) -> Network | None:
    """Fit on texts with labels; None if there is nothing to learn from."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.Generator(np.random.PCG64(settings.seed))
    chunk = next(blocks.chunks(pa.array(texts, pa.string()), limit=1 << 62)) if len(texts) <= 4096 else None
    parts = [chunk] if chunk else list(blocks.chunks(pa.array(texts, pa.string())))
    got = [(windows_of(c.data, c.offsets, settings.window), c.low) for c in parts]
    x = np.concatenate([w for (w, _), _ in got])
    of = np.concatenate([r + low for (_, r), low in got])
    y = np.searchsorted(names, np.array(labels))[of]
    some = (x != 32).sum(axis=1) >= 8
    x, y, of = x[some], y[some], of[some]
    # The windows stand in the order of the rows: how many come before a row's own.
    before = np.searchsorted(of, of)
    f, n_out = settings.filters, len(names)
    net = Network(names, settings.window, [rng.normal(0, 0.3 / width, (width, 256, f)).astype(np.float32) for width in WIDTHS], np.zeros(f * len(WIDTHS), np.float32), rng.normal(0, 0.3, (f * len(WIDTHS), n_out)).astype(np.float32), np.zeros(n_out, np.float32))
    values = [*net.tables, net.bias, net.out, net.out_bias]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(settings.epochs):
        drawn = np.lexsort((rng.random(len(x)), of))
        order = rng.permutation(drawn[np.arange(len(x)) - before < settings.row_windows])
        for low in range(0, len(order), settings.batch):
            own = order[low : low + settings.batch]
            xb, yb = x[own], y[own]
            pooled, where = [], []
            for width, table in zip(WIDTHS, net.tables):
                n = settings.window - width + 1
                response = sum(table[o].take(xb[:, o : o + n], axis=0) for o in range(width))
                best = response.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(response, best[:, None], 1)[:, 0])
            raw = np.concatenate(pooled, axis=1) + net.bias
            hidden = np.maximum(raw, 0)
            grad = _softmax(hidden @ net.out + net.out_bias)
            grad[np.arange(len(yb)), yb] -= 1
            grad /= len(yb)
            back = (grad @ net.out.T) * (raw > 0)
            grads = []
            for i, width in enumerate(WIDTHS):
                g, part = np.zeros_like(net.tables[i]), back[:, i * f : (i + 1) * f]
                for o in range(width):
                    np.add.at(g[o], (xb[np.arange(len(yb))[:, None], where[i] + o], np.arange(f)[None]), part)
                grads.append(g)
            grads += [back.sum(axis=0), hidden.T @ grad, grad.sum(axis=0)]
            step += 1
            for v, g, m, s in zip(values, grads, first, second):
                g = g + settings.decay * v
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", settings: Training = Training()) -> Network | None:
    """Train on at most ``settings.rows`` labelled rows; which rows depends only on their ids and texts, so rows
    without an id or with a repeated one have places of their own.

    The rows are first thinned by hash to little more than that number, so what the tasks send to the driver does
    not grow with the table.
    """
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    share = min(1.0, (1.2 * settings.rows + 200) / max(labelled.count(), 1))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    rows = (
        labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
        .select("id", "text", "label", place.alias("place"))
        .where(F.col("place") <= int(share * (1 << 30)))
        .orderBy("place", "id", "text", "label")
        .limit(settings.rows)
        .toPandas()
    )
    return train(rows["text"].tolist(), rows["label"].tolist(), settings)


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def classify(column: pa.Array, net: Network | None) -> tuple[list[str], np.ndarray]:
    names, scores = [], []
    for chunk in blocks.chunks(column, limit=blocks.CHUNK_BYTES // 4):
        best = np.full(chunk.rows, -1)
        score = np.zeros(chunk.rows)
        if net is not None and len(chunk.data):
            windows, row = windows_of(chunk.data, chunk.offsets, net.window)
            weight = (windows != 32).sum(axis=1) + 1e-3
            p = net.probabilities(windows)
            total = np.stack([np.bincount(row, weights=weight * p[:, k], minlength=chunk.rows) for k in range(p.shape[1])], axis=1)
            some = np.bincount(row, minlength=chunk.rows) > 0
            total[some] /= total[some].sum(axis=1, keepdims=True)
            best, score = np.where(some, total.argmax(axis=1), -1), np.where(some, total.max(axis=1), 0.0)
        ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[chunk.data])])
        plain = ascii_letters[chunk.offsets[1:]] > ascii_letters[chunk.offsets[:-1]]
        for r in range(chunk.rows):
            known = best[r] >= 0 and (plain[r] or _has_letter(chunk.text(r)))
            names.append(net.labels[best[r]] if known else UNDETERMINED)
            scores.append(float(score[r]) if known else 0.0)
    return names, np.clip(np.array(scores), 0, 1)


def predict(net: Network | None, text: str | Column = "text") -> Column:
    """Struct column (``lang_pred``, ``score``) for whole texts.

    A null text and one without a letter are ``und`` with score 0, as are all texts if nothing could be
    learned. ``score`` is the probability of the predicted language. Ties go to the first label in alphabetical order.
    """

    @F.arrow_udf(_SCHEMA)
    def run(texts: pa.Array) -> pa.Array:
        names, scores = classify(texts, net)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return run.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", result_col: str = "language", settings: Training = Training()) -> DataFrame:
    """``docs`` with a struct column ``result_col`` (``lang_pred``, ``score``), learned from the rows not held out.

    All other columns pass unchanged; a column named ``result_col`` is replaced. Repeated rows are judged alike; rows
    with a null id are not held out. An empty table gives an empty one.
    """
    net = fit(docs.where(~held_out(id_col)), id_col, text_col, label_col, settings)
    return docs.withColumn(result_col, predict(net, text_col))
