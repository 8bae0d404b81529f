"""Quality rules: robust multivariate outliers among documents of one language and source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written

SPACE_RUN = r"[\x20\x09-\x0D]+"
ORDINARY = r"[\p{L}\p{N}.,;:'()@+-]+"  # characters of ordinary prose, numbers and addresses
WINDOW = 5  # words of a window for repeats
# Scale floors of the transformed statistics: differences below these are never outlying by themselves.
FLOORS = {"word_length": 0.06, "symbols": 0.03, "capitals": 0.04, "dup_lines": 0.08, "repeats": 0.08}
DIM = len(FLOORS)
SUBSET = 0.75  # share of a group that the determinant is minimised over
CONSISTENCY = 1.41  # makes the covariance of that share consistent for normal data of five dimensions
NEAR = 12.83  # 0.975 quantile of chi-square, 5 degrees of freedom: the reweighting step
LIMIT = 45.0  # squared distance above which a document is rejected
LEAST_GROUP = 100  # smaller groups share the estimates of their language's small groups, still smaller ones those of all documents
EVERY = "\x1f\x1f"  # group of all documents
STEPS = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once per row however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five that the text holds twice or more; windows are compared by 64-bit hash."""

    def covered(hashes: Column) -> Column:
        def starts(sorted_: Column) -> Column:
            same = lambda i, j: F.get(sorted_, i)["h"] == F.get(sorted_, j)["h"]
            twice = lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))
            places = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), twice)
            return F.sort_array(F.transform(places, lambda i: F.get(sorted_, i)["i"]))

        def total(at: Column) -> Column:
            # each start covers five words, or as many as there are before the next start
            gap = lambda k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(WINDOW)))
            return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0).cast("long"), lambda sum_, k: sum_ + gap(k))

        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(order, lambda s: let(starts(s), total)))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, covered))


def statistics(text: Column) -> Column:
    """Struct of counts over a whole text (null: empty), all in one row and without shuffles.

    n_words, word_chars (code points in words), n_symbols (`#*$%&|<>`), n_lines and n_dup_lines (lines with a
    word; equal to an earlier one), n_repeat_words, n_other (characters outside ordinary prose) and
    n_capitals.
    """
    text = F.coalesce(text, F.lit(""))

    def counts(words: Column, lines: Column, body: Column) -> Column:
        size = lambda c: F.length(c).cast("long")
        return F.struct(
            F.size(words).cast("long").alias("n_words"), size(body).alias("word_chars"),
            (size(body) - size(F.regexp_replace(body, "[#*$%&|<>]+", ""))).alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            size(F.regexp_replace(body, ORDINARY, "")).alias("n_other"),
            (size(body) - size(F.regexp_replace(body, r"\p{Lu}+", ""))).alias("n_capitals"),
        )

    words = F.array_remove(F.split(text, SPACE_RUN), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(words, lambda w: let(lines, lambda x: let(F.array_join(w, ""), lambda b: counts(w, x, b))))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vector() -> list[Column]:
    """Transformed statistics; shares are shrunk a little, so short texts are not outlying by chance."""
    words, chars = F.col("n_words") + 20, F.col("word_chars") + 100
    return [
        F.log(chars / words), F.log1p(4 * F.col("n_other") / chars), F.log1p(4 * F.col("n_capitals") / chars),
        F.log1p(2 * F.col("n_dup_lines") / (F.col("n_lines") + 4)), F.log1p(2 * F.col("n_repeat_words") / words),
    ]


def _distance(x: list[Column], centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; `inverse` is a flat matrix."""
    d = [x[i] - F.get(centre, F.lit(i)) for i in range(DIM)]
    terms = [d[i] * d[j] * F.get(inverse, F.lit(i * DIM + j)) * (1 if i == j else 2) for i in range(DIM) for j in range(i, DIM)]
    return sum(terms[1:], terms[0])


def _inverted(matrix: Column) -> Column:
    """Flat positive definite matrix -> its inverse by Gauss-Jordan in place, with the determinant as one more element."""
    n = DIM

    def pivot(a: Column, k: Column) -> Column:
        p = F.get(a, k * n + k)

        def cell(i_j: Column) -> Column:
            i, j = F.floor(i_j / n).cast("int"), i_j % n
            here, up, left = F.get(a, i_j), F.get(a, k * n + j), F.get(a, i * n + k)
            return (
                F.when(i_j == n * n, here * p)
                .when((i == k) & (j == k), 1 / p)
                .when(i == k, here / p)
                .when(j == k, -here / p)
                .otherwise(here - left * up / p)
            )

        return F.transform(F.sequence(F.lit(0), F.lit(n * n)), cell)

    return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.concat(matrix, F.array(F.lit(1.0))), pivot)


def _estimates(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Per group: centre, inverse (flat, determinant last) of factor * covariance plus the squared floors."""
    x = [F.col(f"x{i}") for i in range(DIM)]
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *(F.sum(x[i]).alias(f"s{i}") for i in range(DIM)),
        *(F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i in range(DIM) for j in range(i, DIM)),
    )
    mean = [F.col(f"s{i}") / F.col("n") for i in range(DIM)]
    floor = [v * v for v in FLOORS.values()]

    def cell(i: int, j: int) -> Column:
        a, b = min(i, j), max(i, j)
        return factor * (F.col(f"q{a}{b}") / F.col("n") - mean[a] * mean[b]) + (floor[i] if i == j else 0.0)

    flat = F.array(*(cell(i, j) for i in range(DIM) for j in range(DIM)))
    return sums.select(*keys, F.array(*mean).alias("centre"), _inverted(flat).alias("inverse"))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Minimum covariance determinant per group: (g, centre, inverse) for `rows` (g, x0..x4).

    Two starts, distances from the medians in units of the median deviation and from the classical estimates,
    go through the same concentration steps: keep the closest three quarters, estimate again. The start that
    ends at the smaller determinant wins, then all rows near its estimates give the final ones. Quantiles are
    mergeable sketches and estimates are sums, so a group of any size is combined on the map side; floors on
    the scales keep a group of copies from collapsing. Each step is written to the shared folder.
    """
    x = [F.col(f"x{i}") for i in range(DIM)]
    columns = [f"x{i}" for i in range(DIM)]
    floors = list(FLOORS.values())
    median = rows.groupBy("g").agg(*(F.percentile_approx(c, 0.5).alias(f"m{i}") for i, c in enumerate(columns)))
    off = rows.join(median, "g").select("g", *columns, *(F.abs(F.col(c) - F.col(f"m{i}")).alias(f"o{i}") for i, c in enumerate(columns)))
    spread = off.groupBy("g").agg(*(F.percentile_approx(f"o{i}", 0.5).alias(f"d{i}") for i in range(DIM)))
    scaled = [F.pow(F.col(f"o{i}") / (1.4826 * F.col(f"d{i}") + floors[i]), 2) for i in range(DIM)]
    one = off.join(spread, "g").select("g", F.lit(1).alias("start"), *columns, sum(scaled[1:], scaled[0]).alias("d"))
    two = rows.join(_estimates(rows, ["g"], 1.0), "g").select("g", F.lit(2).alias("start"), *columns, _distance(x, F.col("centre"), F.col("inverse")).alias("d"))
    state, keys = written(one.union(two), "distances"), ["g", "start"]
    for _ in range(STEPS):
        cut = state.groupBy(*keys).agg(F.percentile_approx("d", SUBSET).alias("cut"))
        model = written(_estimates(state.join(cut, keys).where("d <= cut"), keys, CONSISTENCY), "estimates")
        state = state.drop("d").join(model, keys).select(*keys, *columns, _distance(x, F.col("centre"), F.col("inverse")).alias("d"))
    best = model.groupBy("g").agg(F.min_by("start", F.struct(F.element_at("inverse", DIM * DIM + 1), "start")).alias("start"))
    near = state.join(best, keys, "left_semi").where(F.col("d") <= NEAR)
    final = _estimates(near, ["g"], 1.0)
    kept = model.join(best, keys, "left_semi").select("g", F.col("centre").alias("c"), F.col("inverse").alias("v"))
    return kept.join(final, "g", "left").select("g", F.coalesce("centre", "c").alias("centre"), F.coalesce("inverse", "v").alias("inverse"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_other", "n_capitals"]


def judge_quality(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", limit: float = LIMIT) -> DataFrame:
    """Per document: `key`, __text_hash, the counts, base_failed, distance (squared; null if base_failed) and kept.

    Reads the texts once; all further work is on a narrow table of counts in the shared folder. Groups are
    language and source (null: empty); those with fewer than 100 documents that pass the base rules share the
    estimates of their language's small groups; if these are still fewer than 100, those of all documents, however few.
    A null text is empty and fails the base rules. One row per row of `docs`, repeated keys included.
    """
    stats = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text_hash"),
                        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("__lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("__source"),
                        statistics(F.col(text)).alias("__s"))
    stats = written(stats.select(key, "__text_hash", "__lang", "__source", "__s.*"), "counts").withColumn("base_failed", base_failed())
    sizes = stats.where(~F.col("base_failed")).groupBy("__lang", "__source").agg(F.count("*").alias("n"))
    sizes = sizes.select("__lang", "__source", F.when(F.col("n") >= LEAST_GROUP, F.concat_ws("\x1f", "__lang", "__source")).otherwise(F.col("__lang")).alias("g"), "n")
    enough = sizes.groupBy("g").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_GROUP).select("g", F.lit(True).alias("enough"))
    groups = sizes.join(enough, "g", "left").select("__lang", "__source", F.when(F.col("enough"), F.col("g")).otherwise(EVERY).alias("g"))
    groups = written(groups, "groups")
    vectors = stats.where(~F.col("base_failed")).join(groups, ["__lang", "__source"]).select("g", *(v.alias(f"x{i}") for i, v in enumerate(_vector())))
    if groups.where(F.col("g") == EVERY).limit(1).count():  # then every document also counts for the estimates of all
        own = F.when(F.col("g") == EVERY, F.array("g")).otherwise(F.array("g", F.lit(EVERY)))
        vectors = vectors.withColumn("g", F.explode(own))
    models = written(groups.join(robust_estimates(written(vectors, "vectors")), "g"), "models")
    judged = stats.join(models, ["__lang", "__source"], "left")
    distance = F.when(~F.col("base_failed"), _distance(_vector(), F.col("centre"), F.col("inverse")))
    judged = judged.withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    return judged.select(key, "__text_hash", *COUNTS, "base_failed", "distance", kept.alias("kept"))


def keep_quality(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` that `judge_quality` keeps, columns unchanged; the table of rejected rows is narrow and joined by measured size."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    bad = written(judge_quality(docs, **options).where("NOT kept").select(F.col(key).alias("__key"), "__text_hash").distinct(), "rejected")
    same = docs[key].eqNullSafe(bad["__key"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == bad["__text_hash"])
    return docs.join(bad, same, "left_anti")
