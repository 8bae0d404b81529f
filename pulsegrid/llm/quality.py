"""Quality classifier: random-indexing word vectors, pooled per document, a two-layer network, a fitted temperature."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import Cache, slices, texts_of, written

FIT_ROWS = 10_000  # bound of the labelled sample that the model is fitted on
STEMS, SHAPES, DIM, HIDDEN = 8192, 1024, 32, 32
CACHED_WORDS = 200_000
WORDS_PER_STEP = 40_000
CHARS_PER_STEP = 250_000  # of texts pooled at a time: with the line above, a worker's arrays take tens of megabytes

_LETTERS = re.compile(r"[^\W\d_]+")
_RUNS = ((re.compile(r"[^\W\d_A-Z]+"), "a"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1\1"))


def word_code(word: str) -> int:
    """Bucket of the word's letters, and bucket of its shape (`THE!!` is `A!!`), as one number."""
    stem = zlib.crc32("".join(_LETTERS.findall(word)).lower().encode()) % STEMS
    shape = word
    for run, by in _RUNS:
        shape = run.sub(by, shape)
    return stem * SHAPES + zlib.crc32(shape.encode()) % SHAPES


_codes = Cache(CACHED_WORDS)  # kept by a worker from batch to batch


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stem, shape, first word of each text and the end) for all words of `texts`; a word equal to the one before has a shape of its own."""
    known, flat, bounds = _codes, [], [0]
    for t in texts:
        words = t.split()
        for w in words:
            if w not in known:
                known[w] = word_code(w)
        flat.extend([known[w] for w in words])
        bounds.append(len(flat))
    known.trim()
    codes, bounds = np.array(flat, np.int64), np.array(bounds)
    stem, shape = codes // SHAPES, codes % SHAPES
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again[bounds[:-1][bounds[:-1] < len(codes)]] = False
    return stem, shape + SHAPES * again, bounds


def index_vectors(n: int, seed: int, nonzero: int = 4) -> np.ndarray:
    """Sparse ternary vectors, a few +1 and -1 each."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, DIM), np.float32)
    places = rng.permuted(np.tile(np.arange(DIM), (n, 1)), axis=1)[:, :nonzero]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.float32), (n, nonzero)), axis=1)
    return out


def context_sums(texts: list[str], reach: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """For each stem and shape bucket, the sum of the index vectors of its neighbours within `reach` words of a text."""
    base = np.concatenate([index_vectors(STEMS, 11), index_vectors(2 * SHAPES, 13)])
    stems, shapes = np.zeros((STEMS, DIM), np.float64), np.zeros((2 * SHAPES, DIM), np.float64)
    stem, shape, bounds = coded(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    for start in range(0, len(stem), WORDS_PER_STEP):
        part = slice(max(0, start - reach), min(len(stem), start + WORDS_PER_STEP + reach))
        s, h, o = stem[part], shape[part], owner[part]
        own = base[s] + base[STEMS + h]
        total = np.zeros_like(own)
        for d in range(1, reach + 1):
            same = (o[d:] == o[:-d])[:, None]
            total[d:] += own[:-d] * same
            total[:-d] += own[d:] * same
        keep = slice(start - part.start, start - part.start + min(WORDS_PER_STEP, len(stem) - start))
        np.add.at(stems, s[keep], total[keep])
        np.add.at(shapes, h[keep], total[keep])
    return stems, shapes


@dataclass
class QualityModel:
    stems: np.ndarray
    shapes: np.ndarray
    layers: tuple[np.ndarray, ...] | None  # None: one class only, `share` is the score of every text
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    temperature: float = 1.0
    share: float = 1.0

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean word vector of each text, by stem and by shape, and its log length; zeros for a text without words."""
        ends = np.cumsum([len(t) for t in texts]) // CHARS_PER_STEP
        parts = np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1)
        return np.concatenate([self._pooled([texts[i] for i in part]) for part in parts])

    def _pooled(self, texts: list[str]) -> np.ndarray:
        stem, shape, bounds = coded(texts)
        out = np.zeros((len(texts), 2 * DIM + 1), np.float32)
        lengths = np.diff(bounds)
        some = np.flatnonzero(lengths)
        if len(some):
            starts = bounds[:-1][some]
            out[some, :DIM] = np.add.reduceat(self.stems[stem], starts, axis=0)
            out[some, DIM:-1] = np.add.reduceat(self.shapes[shape], starts, axis=0)
            out[some, :-1] /= lengths[some, None]
            out[some, -1] = np.log1p(lengths[some]) / 4
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(float) / self.temperature, -40, 40)))


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def train(model: QualityModel, x: np.ndarray, y: np.ndarray, *, epochs: int = 40, batch: int = 128, rate: float = 3e-3, seed: int = 5) -> None:
    """Fits the network by Adam on four fifths of the rows, and the temperature on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, rows = order[: len(x) // 5], order[len(x) // 5 :]
    model.centre, model.scale = x[rows].mean(axis=0), x[rows].std(axis=0) + 1e-3
    width = x.shape[1]
    layers = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    layers = [w.astype(np.float32) for w in layers]
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    z = ((x - model.centre) / model.scale).astype(np.float32)
    for _ in range(epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), batch):
            pick = rows[at : at + batch]
            hidden = np.tanh(z[pick] @ layers[0] + layers[1])
            error = 1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -40, 40))) - y[pick]
            error /= len(pick)
            inner = error[:, None] * layers[2] * (1 - hidden**2)
            grads = (z[pick].T @ inner + 1e-4 * layers[0], inner.sum(axis=0), hidden.T @ error + 1e-4 * layers[2], error.sum(keepdims=True))
            step += 1
            for w, g, m, v in zip(layers, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.layers = tuple(layers)
    raw = model.logits(x[held]).astype(float) if len(held) else np.zeros(0)
    best = min((float(np.mean(np.logaddexp(0, -(2 * y[held] - 1) * raw / t))), t) for t in np.geomspace(0.5, 8, 60)) if len(held) else (0, 1.0)
    model.temperature = best[1]


def fit_quality(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """A model from at most `fit_rows` labelled documents, those with the least hash of `key`.

    `labels` must hold only rows that may be learned from; rows with a null key or label are left out. Vector
    tables have fixed sizes. The driver sees the partial tables of at most eight tasks, and one pooled vector
    per sampled document. Without labels, or with one class, every text scores the share of label 1 (1 if none).
    """
    picked = labels.select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__y")).where("__id IS NOT NULL AND __y IS NOT NULL")
    picked = written(picked.dropDuplicates(["__id"]).orderBy(F.xxhash64("__id"), "__id").limit(fit_rows), "fit_ids")
    sample = docs.select(F.col(key).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), "__id")  # at most fit_rows narrow rows
    sample = written(sample.select("__id", "__y", "text"), "fit_texts").coalesce(8)
    schema = pa.schema([("stems", pa.binary()), ("shapes", pa.binary())])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0.0, 0.0]
        for batch in batches:
            for part in slices(batch, "text", 2_000_000):
                total = [a + b for a, b in zip(total, context_sums(texts_of(part)), strict=True)]
        if not np.isscalar(total[0]):
            packed = [[t.astype(np.float32).tobytes()] for t in total]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.binary()) for p in packed], schema=schema)

    sums = sample.select("text").mapInArrow(contexts, "stems binary, shapes binary").collect()
    table = lambda c, n: unit(sum((np.frombuffer(r[c], np.float32).reshape(n, DIM) for r in sums), np.zeros((n, DIM), np.float32)))
    model = QualityModel(table("stems", STEMS), table("shapes", 2 * SHAPES), None)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2_000_000):
                x = model.pooled(texts_of(part))
                yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("__y"), pa.array([v.tobytes() for v in x], pa.binary())], ["__id", "__y", "x"])

    kind = docs.schema[key].dataType.simpleString()
    rows = sorted(sample.mapInArrow(vectors, f"__id {kind}, __y int, x binary").collect(), key=lambda r: r["__id"])
    y = np.array([r["__y"] for r in rows], np.float32)
    if len(y) < 10 or y.min() == y.max():
        model.share = float(y.mean()) if len(y) else 1.0
    else:
        train(model, np.array([np.frombuffer(r["x"], np.float32) for r in rows]), y)
    return model


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", into: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all) of `docs` with the score of every whole text, in a column that replaces one of the same name.

    Scores lie in 0..1; a null text is an empty one, and empty texts are scored like any other. Narrow: no shuffle.
    """
    keep = [c for c in (keep or docs.columns) if c != into]
    schema = docs.select(*keep).schema.add(into, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in slices(batch, text, 2_000_000):
                scores = pa.array(own.scores(own.pooled(texts_of(part, text))), pa.float64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), scores], [*keep, into])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def learnable(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that may be learned from; those whose crc32 of the key as text is divisible by 5 are held out."""
    return labels.where(F.crc32(F.col(key).cast("string")) % 5 != 0)
