"""Toxicity by class-conditional Kneser-Ney models over the characters of words, toxic against ordinary.

A word is spelled between two spaces; each character follows up to five characters of its word. The highest order is
counted per class. Below it both classes share one chain of continuation counts, so expressions that are rare in both
say nothing, and a stem counts in forms that were never seen. The log-likelihood ratio per word of a text, and how much
of it comes from words that are likelier in toxic texts by some factor or more, go through a logistic curve fitted on labelled documents
that were left out of the counts.

The ratios of all grams are a table that Spark makes by joins over the orders. Workers get the common ones; words with
a rare gram are joined to the whole table, so every gram has its own ratio however many there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from pulsegrid.llm.common import Cache, slices, texts_of, written
from pulsegrid.llm.fuzzy_lines import _places, bloom

ORDER = 6  # characters of a gram
DISCOUNT = 0.75
NEAR_ROWS = 1 << 20  # bound of the grams and histories that workers hold; words with others are joined to all of them
FIT_ROWS = 20_000  # bound of the labelled sample that the logistic curve is fitted on
TELLING = (1.0, 3.0, 5.0)  # log-likelihood ratios beyond which the excess of a word counts by itself
CACHED_WORDS, FLUSH = 400_000, 400_000


def grams(word: str) -> list[str]:
    """Each character of the word and its end, after as much of the word's start as an order holds."""
    s = f" {word} "
    return [s[max(0, i - ORDER + 1) : i + 1] for i in range(1, len(s))]


def count_grams(rows: DataFrame) -> DataFrame:
    """(gram, n0, n1): how often the grams of `rows` (text, y) occur in ordinary and toxic texts; all rows count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: tuple[Counter, Counter] = (Counter(), Counter())

        def packed() -> pa.RecordBatch:
            own: tuple[Counter, Counter] = (Counter(), Counter())
            for counts, known in zip(own, words, strict=True):
                for w, n in known.items():
                    for g in grams(w):
                        counts[g] += n
                known.clear()
            names = list(own[0].keys() | own[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[g] for g in names], pa.int64()) for c in own)], ["gram", "n0", "n1"])

        for batch in batches:
            for y, t in zip(batch.column("y").to_pylist(), texts_of(batch), strict=True):
                words[y].update(t.lower().split())
                if len(words[0]) + len(words[1]) > FLUSH:
                    yield packed()
        yield packed()

    found = rows.mapInArrow(run, "gram string, n0 long, n1 long")
    return found.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _history(c: str = "gram") -> F.Column:
    return F.expr(f"left({c}, length({c}) - 1)")


def model_tables(counted: DataFrame) -> DataFrame:
    """(gram, history, n, value) of all counts, written: of a gram its log-likelihood ratio, of a history that of any gram never seen after it.

    `n` is how often it occurs. The lower orders are counts of distinct left neighbours; each order's shared probability
    comes by joins from the one below.
    """
    below = lambda c: F.expr(f"substring({c}, 2)")
    less = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
    types, longer = {}, counted.where(F.length("gram") == ORDER).select("gram")
    for k in range(ORDER - 1, 0, -1):
        types[k] = written(longer.groupBy(below("gram").alias("gram")).agg(F.count("*").alias("a")), f"order{k}")
        longer = types[k].select("gram").union(counted.where((F.length("gram") == k) & F.col("gram").startswith(" ")).select("gram"))
    shared = None
    for k in range(1, ORDER):
        back = types[k].groupBy(_history().alias("h")).agg(F.sum("a").alias("total"), F.count("*").alias("kinds"))
        rows = types[k].withColumn("h", _history()).join(back, "h")
        rows = rows.withColumn("base", 1 / (F.col("kinds") + 1)) if shared is None else rows.join(lower, below("gram") == F.col("tail"))
        p = rows.select(F.col("gram").alias("tail"), ((less("a") + DISCOUNT * F.col("kinds") * F.col("base")) / F.col("total")).alias("base"))
        lower = written(p, f"shared{k}")
        shared = lower if shared is None else shared.union(lower)
    own = counted.withColumn("h", _history())
    # What the grams of a history leave to all others.
    left = lambda c: F.sum(F.col(c) - less(c))
    seen = own.groupBy("h").agg(F.sum("n0").alias("all0"), F.sum("n1").alias("all1"), left("n0").alias("left0"), left("n1").alias("left1"))
    weight = lambda c: F.when(F.col(f"all{c}") > 0, F.col(f"left{c}") / F.col(f"all{c}")).otherwise(1.0)
    seen = written(seen.select("h", "all0", "all1", weight(0).alias("w0"), weight(1).alias("w1")), "histories")
    chance = lambda c: F.when(F.col(f"all{c}") > 0, less(f"n{c}") / F.col(f"all{c}")).otherwise(0.0) + F.col(f"w{c}") * F.col("base")
    rows = own.join(seen, "h").join(shared, below("gram") == F.col("tail"))
    rows = rows.select("gram", F.lit(False).alias("history"), (F.col("n0") + F.col("n1")).alias("n"), (F.log(chance(1)) - F.log(chance(0))).alias("value"))
    return written(rows.union(seen.select("h", F.lit(True), F.col("all0") + F.col("all1"), F.log("w1") - F.log("w0"))), "model")


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points plus one of `words`, each after `ORDER` - 1 zeros, and where each begins."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + ORDER - 1
    pad = " " * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(words)).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    first = np.cumsum(lengths) - lengths
    codes[(first[:, None] + np.arange(ORDER - 1)).ravel()] = 0
    return codes, first


def _hashes(codes: np.ndarray, at: np.ndarray, history: bool = False) -> np.ndarray:
    """64-bit hashes of the `ORDER` code points that end at each place of `at`, or of the history before it."""
    bits = [np.uint64(21 * k) for k in range(3)]
    a = codes[at - 5] | codes[at - 4] << bits[1] | codes[at - 3] << bits[2]
    last = np.uint64((1 << 21) - 1) if history else codes[at]  # no code point is that large
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += codes[at - 2] | codes[at - 1] << bits[1] | last << bits[2]
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def _entry_hashes(names: list[str], history: np.ndarray) -> np.ndarray:
    """Hashes of grams, and of histories where `history` says so."""
    codes, first = _codes([g + " " if h else g for g, h in zip(names, history, strict=True)])
    at = np.append(first[1:], len(codes)) - 1
    return np.where(history, _hashes(codes, at, True), _hashes(codes, at)) if names else np.empty(0, np.uint64)


@dataclass
class Ratios:
    """The common grams and histories by hash. `rare`: a bit table of all others, None if there are none."""

    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # ascending
    values: np.ndarray = field(default_factory=lambda: np.empty(0))
    rare: np.ndarray | None = None

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each hash: its value, whether it has one here, whether it may be a rare one."""
        own, back = np.unique(hashes, return_inverse=True)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            found = self.keys[at] == own
            values = np.where(found, self.values[at], 0.0)
        else:
            found, values = np.zeros(len(own), bool), np.zeros(len(own))
        rare = ~found if self.rare is not None else np.zeros(len(own), bool)
        if rare.any():
            for place in _places(own.view(np.int64), len(self.rare) * 8):
                rare &= (self.rare[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return values[back], found[back], rare[back]

    def words(self, words: list[str]) -> np.ndarray:
        """The ratio of each word, the sum over its grams; nan if it may have a gram or history that is not here."""
        codes, first = _codes([f" {w} " for w in words])
        begin = first + ORDER  # the first character of each word
        end = np.append(first[1:], len(codes))
        sizes = end - begin
        starts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(begin - starts, sizes)
        values, found, rare = self.find(_hashes(codes, at))
        other = np.flatnonzero(~found)
        values[other], _, unsure = self.find(_hashes(codes, at[other], True))
        values[other[rare[other] | unsure]] = np.nan
        return np.add.reduceat(values, starts)


@dataclass
class ToxicityModel:
    """`near`: what workers hold, with `names` (gram, history, value); `entries`: all grams and histories, a table in the shared folder."""

    near: Ratios = field(default_factory=Ratios)
    names: pa.Table | None = None
    entries: DataFrame | None = None
    curve: tuple | None = None  # None: one class only, `share` is the score of every text
    share: float = 0.0

    @property
    def ratio(self) -> dict[str, float]:
        """Log-likelihood ratios of the grams that workers hold."""
        columns = self.names.to_pydict() if self.names is not None else {"gram": [], "history": [], "value": []}
        return {g: v for g, h, v in zip(columns["gram"], columns["history"], columns["value"], strict=True) if not h}

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _scores(x, self.curve, self.share)


def _scores(x: np.ndarray, curve: tuple | None, share: float) -> np.ndarray:
    if curve is None:
        return np.full(len(x), share)
    centre, scale, weights = curve
    return 1 / (1 + np.exp(-np.clip(_inputs(x, centre, scale) @ weights, -40, 40)))


def sums(texts: list[str], near: Ratios, known: dict) -> tuple[np.ndarray, list[list[tuple[str, int]]]]:
    """Of each text: sum of the ratios of its words, number of words, summed excess over each of `TELLING`.

    The second list has the words (and how often) whose ratio `near` does not know and the sums leave out.
    """
    out, rare = np.zeros((len(texts), 2 + len(TELLING))), []
    split = [t.lower().split() for t in texts]
    new = [w for w in set().union(*split) if w not in known]
    for i in range(0, len(new), 1 << 16):
        known.update(zip(new[i : i + (1 << 16)], near.words(new[i : i + (1 << 16)]).tolist(), strict=True))
    for i, words in enumerate(split):
        own = []
        if words:
            ratios = np.fromiter(map(known.__getitem__, words), float, len(words))
            if near.rare is not None and (gone := np.isnan(ratios)).any():
                own = list(Counter(words[k] for k in np.flatnonzero(gone)).items())
                ratios = ratios[~gone]
            out[i] = ratios.sum(), len(words), *(np.maximum(ratios - t, 0).sum() for t in TELLING)
        rare.append(own)
    return out, rare


def _inputs(x: np.ndarray, centre: np.ndarray | float = 0.0, scale: np.ndarray | float = 1.0) -> np.ndarray:
    length = np.log1p(x[:, 1])
    z = (np.column_stack([x[:, 0], length, x[:, 0] * length, np.log(x[:, 2:] + 1e-3)]) - centre) / scale
    return np.column_stack([z, np.ones(len(z))])


def kneser_ney(entries: DataFrame) -> ToxicityModel:
    """A model without a curve from all grams and histories: workers hold the most frequent, at most `NEAR_ROWS`, and a bit table of the others."""
    level = F.floor(F.log2("n"))
    counts = {int(b): int(n) for b, n in entries.groupBy(level).agg(F.count("*")).collect()}  # a row for each power of two
    least, total = max(counts, default=0) + 1, 0
    for b in sorted(counts, reverse=True):
        total += counts[b]
        if total > NEAR_ROWS:
            break
        least = b
    common = level >= least
    names = entries.where(common).select("gram", "history", "value").toArrow()
    keys = _entry_hashes(names["gram"].to_pylist(), names["history"].to_numpy())
    order = np.argsort(keys)
    near = Ratios(keys[order], names["value"].to_numpy()[order])
    if others := sum(n for b, n in counts.items() if b < least):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = _entry_hashes(batch["gram"].to_pylist(), batch["history"].to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64))], ["id"])

        near.rare = bloom(entries.where(~common).select("gram", "history").mapInArrow(run, "id long"), others)
    return ToxicityModel(near, names, entries)


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple:
    """Logistic regression by Newton's method with a small ridge."""
    raw = _inputs(x)[:, :-1]
    centre, scale = raw.mean(axis=0), raw.std(axis=0) + 1e-9
    z = _inputs(x, centre, scale)
    weights, ridge = np.zeros(z.shape[1]), 1e-2 * np.eye(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -40, 40)))
        slope = z.T @ (p - y) + ridge @ weights
        bend = (z * (p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(bend, slope)
        weights = weights - step * min(1, 4 / (np.abs(step).max() + 1e-12))
    return centre, scale, weights


def _labelled(docs: DataFrame, labels: DataFrame, text: str, key: str) -> DataFrame:
    """(text, y) of all documents in `labels` (id, y). A bit table of at most 16 MB leaves most others out before the shuffle."""
    hashes = labels.select(F.xxhash64("id").alias("id"))
    table = docs.sparkSession.sparkContext.broadcast(bloom(hashes, labels.count()))

    @F.pandas_udf("boolean")
    def maybe(ids: pd.Series) -> pd.Series:
        hit = np.ones(len(ids), bool)
        for place in _places(ids.to_numpy(), len(table.value) * 8):
            hit &= (table.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return pd.Series(hit)

    own = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(maybe(F.xxhash64("id")))
    return own.join(labels, "id").select("text", "y")


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """A model from all documents in `labels`, which must hold only rows that may be learned from.

    Four fifths of them (by a hash of the key) give the counts, whole and without a bound; at most `fit_rows` of the rest
    give the logistic curve. Rows with a null key or label are left out; a key with several labels is toxic if one says
    so. The driver sees the common grams, at most `NEAR_ROWS`, and a few numbers per document of that sample. Without
    labels, or with one class, every text scores the share of toxic labels (0 if none).
    """
    own = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    own = written(own.groupBy("id").agg(F.max("y").alias("y")), "labels")
    n, toxic = own.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < toxic < n:
        return ToxicityModel(share=float(toxic / n) if n else 0.0)
    apart = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    model = kneser_ney(model_tables(written(count_grams(_labelled(docs, own.where(~apart), text, key)), "grams")))
    picked = written(own.where(apart).orderBy(F.xxhash64("id"), "id").limit(fit_rows), "fit_ids")
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")  # at most fit_rows narrow rows
    rows = np.array([tuple(r) for r in _features(sample, model, "text", ["y"]).drop("__score").collect()])
    if len(rows) and 0 < rows[:, 0].sum() < len(rows):
        model.curve = fit_curve(rows[:, 1:], rows[:, 0])
    else:
        model.share = float(toxic / n)
    return model


def _word_ratios(words: DataFrame, entries: DataFrame) -> DataFrame:
    """(word, ratio) of distinct `words`, by joins of all their grams and histories to `entries`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.column("word").slice(at, 1024).to_pylist()
                own = [grams(w) for w in part]
                names = [g for gs in own for g in gs]
                columns = [[w for w, gs in zip(part, own, strict=True) for _ in gs], names, [g[:-1] for g in names]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["word", "g", "h"])

    rows = words.mapInArrow(run, "word string, g string, h string")
    of = lambda c, history, value: entries.where(F.col("history") == history).select(F.col("gram").alias(c), F.col("value").alias(value))
    rows = rows.join(of("g", False, "own"), "g", "left").join(of("h", True, "unseen"), "h", "left")
    return rows.groupBy("word").agg(F.sum(F.coalesce("own", "unseen", F.lit(0.0))).alias("ratio"))


def _features(docs: DataFrame, model: ToxicityModel, text: str, keep: list[str]) -> DataFrame:
    """The columns `keep` and, of each text: mean ratio of its words, number of words, mean excess over each of `TELLING`, score.

    Zeros for a text without words. Narrow if workers hold the whole model. Else the sums over the words that they know
    are written, words with a rare gram get their ratio by joins, and what they add to a text meets it by the text's digest.
    """
    over = [f"__over{t:g}" for t in TELLING]
    names = ["__ratio", "__words", *over, "__score"]
    doubles = lambda columns: [StructField(c, DoubleType()) for c in columns]
    kept_fields = list(docs.select(*keep).schema)
    shared = docs.sparkSession.sparkContext.broadcast(model.near)  # bounded by NEAR_ROWS
    curve, share = model.curve, model.share

    def means(x: np.ndarray) -> np.ndarray:
        x[:, [0, *range(2, x.shape[1])]] /= np.maximum(x[:, 1:2], 1)
        return x

    def summed(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        near, known = shared.value, Cache(CACHED_WORDS)
        for batch in batches:
            for part in slices(batch, text, 2_000_000):
                texts = texts_of(part, text)
                x, rare = sums(texts, near, known)
                known.trim()
                kept = [part.column(c) for c in keep]
                if whole:
                    x = means(x)
                    yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, x.T), pa.array(_scores(x, curve, share))], [*keep, *names])
                else:
                    digests = pa.array([xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary())
                    lists = pa.array([[{"word": w, "n": n} for w, n in own] for own in rare], pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))
                    yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, x.T), digests, lists], [*keep, *names[:-1], "__text", "__rare"])

    rows = docs.select(*dict.fromkeys([*keep, text]))
    final = StructType(kept_fields + doubles(names))
    if model.near.rare is None:
        return rows.mapInArrow(lambda batches: summed(batches, True), final)
    wide = StructType(kept_fields + doubles(names[:-1])).add("__text", "binary").add("__rare", ArrayType(StructType().add("word", "string").add("n", "long")))
    rows = written(rows.mapInArrow(lambda batches: summed(batches, False), wide), "sums")
    rare = rows.where(F.size("__rare") > 0).select("__text", F.explode("__rare").alias("r")).select("__text", "r.word", "r.n").dropDuplicates(["__text", "word"])
    ratios = written(_word_ratios(rare.select("word").distinct(), model.entries), "rare_words")
    more = [F.sum(F.col("n") * F.col("ratio")), *(F.sum(F.col("n") * F.greatest(F.col("ratio") - t, F.lit(0.0))) for t in TELLING)]
    added = rare.join(ratios, "word").groupBy("__text").agg(*(e.alias(f"__more{i}") for i, e in enumerate(more)))
    plus = {c: F.col(c) + F.coalesce(f"__more{i}", F.lit(0.0)) for i, c in enumerate(["__ratio", *over])}
    rows = rows.join(added, "__text", "left").withColumns(plus).select(*keep, *names[:-1])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = means(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names[:-1]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, x.T), pa.array(_scores(x, curve, share))], [*keep, *names])

    return rows.mapInArrow(scored, final)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text: str = "text", into: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all) of `docs` with the score of every whole text, in a column that replaces one of the same name.

    Scores lie in 0..1; a null text is an empty one, and empty texts are scored like any other. Narrow, without a shuffle,
    unless the model has rare grams; then only sums and words that have such a gram are shuffled.
    """
    keep = [c for c in (keep or docs.columns) if c != into]
    return _features(docs, model, text, keep).select(*keep, F.col("__score").alias(into))


def learnable(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows that may be learned from; those whose crc32 of the key as text leaves 2 when divided by 4 are held out."""
    return labels.where(F.crc32(F.col(key).cast("string")) % 4 != 2)
