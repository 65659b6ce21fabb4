"""Language identification with a byte convolutional network trained in numpy.

Bytes are mapped to classes (ASCII letters without case, continuation bytes, lead bytes,
the rest), filters of several widths slide over fixed-length windows, each filter keeps its
maximum over the window, and a softmax layer reads the maxima. A text's prediction is the
mean of its windows' probabilities, weighted by their bytes; every byte of it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.llm.frames import id_and_text
from genoframe.llm.textbuf import LOWER, chunks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
UNKNOWN = "und"


def _classes() -> np.ndarray:
    c = np.zeros(256, dtype=np.int64)                  # 0: everything that is not a letter, and padding
    for b in range(256):
        low = int(LOWER[b])
        if 0x61 <= low <= 0x7A:
            c[b] = 1 + low - 0x61
        elif 0x80 <= b < 0xC0:
            c[b] = 27 + b - 0x80
        elif b >= 0xC0:
            c[b] = 91 + min((b - 0xC0) >> 1, 7)
    return c


CLASS = _classes()
N_CLASS = 99


@dataclass
class Model:
    labels: list[str]
    filters: list[np.ndarray]      # per width: (width, N_CLASS, FILTERS)
    bias: np.ndarray               # (len(WIDTHS) * FILTERS,)
    dense: np.ndarray              # (len(WIDTHS) * FILTERS, labels)
    dense_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Filter responses by pairs of classes, so that a position costs one or two look-ups."""
        pair = np.concatenate([(w[0][:, None, :] + w[1][None, :, :]).reshape(-1, FILTERS) for w in self.filters], axis=1)
        third = self.filters[1][2]
        last = (self.filters[2][2][:, None, :] + self.filters[2][3][None, :, :]).reshape(-1, FILTERS)
        return pair.astype(np.float32), third.astype(np.float32), last.astype(np.float32)


def windows_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class windows ``(n, WINDOW + 4)`` over every row's bytes, the row of each window and its bytes."""
    size = np.diff(off)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    first = np.cumsum(count) - count
    nth = np.arange(len(row)) - first[row]
    start = off[:-1][row] + nth * WINDOW
    used = np.minimum(size[row] - nth * WINDOW, WINDOW)
    padded = np.concatenate([CLASS[buf], np.zeros(WINDOW + 4, dtype=np.int64)])
    take = np.arange(WINDOW + 4)
    grid = padded[start[:, None] + take[None, :]]
    grid[take[None, :] >= used[:, None]] = 0
    return grid, row, used


def probabilities(model: Model, tables, grid: np.ndarray) -> np.ndarray:
    pair_t, third_t, last_t = tables
    out = np.empty((len(grid), len(model.labels)))
    for at in range(0, len(grid), 64):
        c = grid[at: at + 64]
        pair = c[:, :-1] * N_CLASS + c[:, 1:]
        resp = pair_t[pair[:, :WINDOW]]
        resp[:, :, FILTERS: 2 * FILTERS] += third_t[c[:, 2: WINDOW + 2]]
        resp[:, :, 2 * FILTERS:] += last_t[pair[:, 2: WINDOW + 2]]
        top = np.maximum(resp.max(axis=1) + model.bias, 0)
        z = top @ model.dense + model.dense_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        out[at: at + 64] = z / z.sum(axis=1, keepdims=True)
    return out


def train(texts: list[bytes], langs: list[str], epochs: int = 12, rate: float = 0.01, seed: int = 7) -> Model | None:
    """Fit the network on windows of the labelled texts (Adam, cross-entropy).

    Max pooling passes a gradient to the best position of each filter only, so a step
    updates the filter weights of one window position per filter.
    """
    labels = sorted(set(langs))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    n_feat = FILTERS * len(WIDTHS)
    model = Model(labels, [rng.normal(0, 0.3, (w, N_CLASS, FILTERS)) for w in WIDTHS], np.zeros(n_feat),
                  rng.normal(0, 0.2, (n_feat, len(labels))), np.zeros(len(labels)))
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    grid, row, used = windows_of(joined, off)
    keep = (grid > 0).sum(axis=1) >= 8
    grid, row = grid[keep], row[keep]
    if not len(grid):
        return None
    number = {lang: i for i, lang in enumerate(labels)}
    y = np.array([number[lang] for lang in langs])[row]
    params = [*model.filters, model.bias, model.dense, model.dense_bias]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, feat = 0, np.arange(FILTERS)
    for _ in range(epochs):
        for pick in np.array_split(rng.permutation(len(grid)), max(1, len(grid) // 32)):
            c, want, n = grid[pick], y[pick], len(pick)
            best, top = [], np.empty((n, n_feat))
            for k, w in enumerate(WIDTHS):
                resp = sum(model.filters[k][j][c[:, j: WINDOW + j]] for j in range(w))
                at = resp.argmax(axis=1)
                best.append(at)
                top[:, k * FILTERS: (k + 1) * FILTERS] = np.take_along_axis(resp, at[:, None, :], axis=1)[:, 0]
            act = np.maximum(top + model.bias, 0)
            z = act @ model.dense + model.dense_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), want] -= 1
            p /= n
            back = (p @ model.dense.T) * (act > 0)
            grads = []
            for k, w in enumerate(WIDTHS):
                g = np.zeros_like(model.filters[k])
                part = back[:, k * FILTERS: (k + 1) * FILTERS]
                for j in range(w):
                    cls = np.take_along_axis(c, best[k] + j, axis=1)
                    np.add.at(g[j], (cls, np.broadcast_to(feat, cls.shape)), part)
                grads.append(g)
            grads += [back.sum(axis=0), act.T @ p, p.sum(axis=0)]
            step += 1
            for q, g, a, b in zip(params, grads, m1, m2):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return model


def labelled_sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str,
                    per_lang: int, max_langs: int) -> tuple[list[bytes], list[str]]:
    """About ``per_lang`` labelled texts of each of the ``max_langs`` commonest languages, at most
    two windows of each, chosen by a hash of the id. The result holds at most about
    ``per_lang * max_langs * 2 * WINDOW`` bytes."""
    usable = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(F.trim(F.col(text_col))) > 0))
    counts = usable.groupBy(F.col(lang_col).alias("k")).count().orderBy(F.desc("count"), "k").limit(max_langs).collect()
    if not counts:
        return [], []
    share = F.create_map(*[x for r in counts for x in (F.lit(r["k"]), F.lit(min(1.0, per_lang / r["count"])))])
    h = F.xxhash64(F.lit(17), F.col(id_col).cast("string"))
    place = F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))
    length = 2 * WINDOW
    start = F.pmod(F.xxhash64(F.lit(23), F.col(id_col).cast("string")), F.greatest(F.length(text_col) - length, F.lit(1))) + 1
    rows = (usable.where(place < F.element_at(share, F.col(lang_col)))
            .select(F.col(lang_col).alias("k"), F.col(text_col).substr(start.cast("int"), F.lit(length)).alias("t")).collect())
    rows.sort(key=lambda r: (r["k"], r["t"]))
    return [r["t"].encode() for r in rows], [r["k"] for r in rows]


def learnable(id_col: str = "doc_id") -> Column:
    """Documents that training may use: crc32 of the id's text, modulo 4, is not 2."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 400, max_langs: int = 200) -> Model | None:
    """Train on a bounded labelled sample (``per_lang`` texts of each language)."""
    texts, langs = labelled_sample(docs, F.coalesce(learnable(id_col), F.lit(False)), id_col, text_col, lang_col, per_lang, max_langs)
    return train(texts, langs)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, n_windows`` for every row from its whole text.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or where
    no labelled text was there to learn from. Repeated rows each give a row; ties go to the
    first label in order.
    """
    def run(batches):
        for part, label, score, wins in _predictions(batches, model, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(wins, pa.int64())],
                ["doc_id", "lang_pred", "score", "n_windows"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, n_windows bigint")


def recognised(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text gets a language: one pass, no shuffle.

    Rows with a null text or one without a letter go. With ``lang_col``, a null there becomes the predicted language.
    Without a model (nothing to learn from) rows with a letter stay and no language is written. A null
    id, repeated rows and other columns do not matter.
    """
    at = docs.columns.index(lang_col) if lang_col else None

    def run(batches):
        for part, label, _, _ in _predictions(batches, model, text_col):
            if model is None:
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                keep = [bool(t) and any(ch.isalpha() for ch in t) for t in texts]
            else:
                keep = [x != UNKNOWN for x in label]
                if at is not None:
                    lang = part.column(at)
                    part = part.set_column(at, part.schema.field(at), pc.coalesce(lang, pa.array(label, lang.type)))
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _predictions(batches, model: Model | None, text_col: str):
    """Slices of the batches with the label, score and number of windows of every row."""
    tables = model.tables() if model else None
    for part, chunk in chunks(batches, text_col, max_bytes=256 << 10):
        n = len(chunk)
        label, score, wins = [UNKNOWN] * n, np.zeros(n), np.zeros(n, dtype=np.int64)
        if model:
            total, weight = np.zeros((n, len(model.labels))), np.zeros(n)
            # a very long text is read a part at a time; parts end where windows do
            for lo, hi, first in _parts(chunk.off, 256 << 10):
                grid, row, used = windows_of(chunk.buf[lo:hi], np.clip(chunk.off, lo, hi) - lo) if first is None else \
                    windows_of(chunk.buf[lo:hi], np.array([0, hi - lo]))
                if first is not None:
                    row = row + first
                prob = probabilities(model, tables, grid) * used[:, None]
                np.add.at(total, row, prob)
                np.add.at(weight, row, used)
                wins += np.bincount(row, minlength=n)
            texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
            for i, text in enumerate(texts):
                if text and weight[i] and any(ch.isalpha() for ch in text):
                    k = int(total[i].argmax())
                    label[i], score[i] = model.labels[k], min(1.0, float(total[i][k] / weight[i]))
        yield part, label, score, wins


def _parts(off: np.ndarray, size: int):
    """Byte ranges of a chunk: all of it, or the parts of its single long row."""
    if len(off) > 2 or off[-1] <= size:
        yield 0, int(off[-1]), None
        return
    step = size // WINDOW * WINDOW
    for lo in range(0, int(off[-1]), step):
        yield lo, min(lo + step, int(off[-1])), 0
