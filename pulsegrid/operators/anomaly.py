"""Z-score detection on window counts and on running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.texts import anomaly_message
from ..functions.timing import HOUR, MINUTE, SECOND, floor_ms
from .windows import KEYS

SIGMAS = 3.0
RUNNING_HISTORY = 10
WINDOW_HISTORY = 60


_WHOLE = "decimal(20,0)"
_SUM = "decimal(38,0)"


def _zscore(n: str, x: str, total: str, squares: str) -> str:
    """|x - mean| / sigma of whole numbers, from exact sums: |n x - sum| / sqrt(n sum2 - sum^2).

    Scores of exactly 3 are common on small counts (one event in ten windows, for one) and must
    not be tipped over the limit by rounding.
    """
    spread = f"({n} * {squares} - {total} * {total})"
    return f"CASE WHEN {spread} > 0 THEN cast(abs({n} * {x} - {total}) as double) / sqrt(cast({spread} as double)) END"


def zscore_windows(
    counts: DataFrame, history: int = WINDOW_HISTORY, min_history: int = 10, sigmas: float = SIGMAS,
    keys: list[str] = KEYS, order: str = "window_start", value: str = "count",
) -> DataFrame:
    """Z-score of each closed window against up to `history` windows before it, per key.

    Too little history gives z = 0 and no anomaly, so does a history without any spread.
    Input is one whole number per key and window, so a key's rows are bounded by time.
    """
    over = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order} ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING)"
    x = f"cast({value} as {_WHOLE})"
    framed = counts.selectExpr(
        "*", f"count({value}) {over} AS _n", f"cast(sum({x}) {over} as {_SUM}) AS _sum",
        f"cast(sum({x} * {x}) {over} as {_SUM}) AS _squares",
    )
    z = f"coalesce(CASE WHEN _n >= {min_history} THEN {_zscore('_n', x, '_sum', '_squares')} END, 0.0D)"
    return (
        framed.selectExpr("*", "coalesce(cast(_sum as double) / _n, 0.0D) AS history_avg", f"{z} AS z_score")
        .withColumn("is_anomaly", F.col("z_score") > sigmas)
        .drop("_n", "_sum", "_squares")
    )


def running_counts(
    events: DataFrame, duration_ms: int = MINUTE, keys: list[str] = KEYS, ts: str = "timestamp",
    seq: str = "seq", sub_ms: int = SECOND,
) -> DataFrame:
    """Position of each event in its window, in arrival order.

    Ranking runs per (key, second); the number of events in earlier seconds of the window is
    added from per-second counts. No task has to order a whole window of a hot key.
    """
    parts = events.withColumn("window_start", floor_ms(ts, duration_ms)).withColumn("_sub", floor_ms(ts, sub_ms))
    cell = [*keys, "window_start", "_sub"]
    earlier = W.partitionBy(*keys, "window_start").orderBy("_sub").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(*cell)
        .agg(F.count("*").alias("_c"))
        .select(*cell, F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(W.partitionBy(*cell).orderBy(ts, seq))
    offsets = offsets.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(cell)], "_before")
    same = F.lit(True)
    for i, c in enumerate(cell):
        same = same & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    return (
        parts.withColumn("_local", local)
        .join(offsets, same)
        .drop(*[f"_o{i}" for i in range(len(cell))])
        .withColumn("running_count", F.col("_local") + F.col("_before"))
        .drop("_local", "_before", "_sub")
    )


def _history_scores(events: DataFrame, duration_ms: int, history: int, sigmas: float, keys: list[str], ts: str) -> DataFrame:
    """Z-score of the first `history` positions of every window, from window counts alone.

    The checked values are the running counts 1, 2, .. n of successive windows. What precedes
    position p is therefore known from the counts of at most `history` earlier windows.
    """
    h = history
    counts = events.groupBy(*keys, floor_ms(ts, duration_ms).alias("window_start")).agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*keys).orderBy("window_start").rowsBetween(-h, -1)
    down = lambda n: F.sequence(n, F.greatest(n - F.lit(h - 1), F.lit(1)), F.lit(-1).cast("bigint"))
    tail = F.slice(F.flatten(F.transform(F.reverse(F.collect_list("_n").over(earlier)), down)), 1, h)
    positions = F.sequence(F.lit(1).cast("bigint"), F.least(F.col("_n"), F.lit(h)))
    rows = counts.withColumn("_tail", tail).withColumn("running_count", F.explode(positions))
    p = F.col("running_count")
    own = F.when(p > 1, F.sequence(p - 1, F.lit(1).cast("bigint"), F.lit(-1).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )
    rows = rows.withColumn("_hist", F.slice(F.concat(own, "_tail"), 1, h))
    total = f"aggregate(_hist, cast(0 as {_SUM}), (a, v) -> cast(a + v as {_SUM}))"
    squares = f"aggregate(_hist, cast(0 as {_SUM}), (a, v) -> cast(a + cast(v as {_WHOLE}) * v as {_SUM}))"
    sums = rows.selectExpr("*", f"{total} AS _sum", f"{squares} AS _squares")
    z = _zscore(f"cast({h} as bigint)", "running_count", "_sum", "_squares")
    return sums.selectExpr(
        *keys, "window_start", "running_count",
        f"coalesce(CASE WHEN size(_hist) >= {h} THEN {z} END, 0.0D) AS z_score",
    ).withColumn("is_anomaly", F.col("z_score") > sigmas)


def zscore_running(
    events: DataFrame, duration_ms: int = MINUTE, history: int = RUNNING_HISTORY, sigmas: float = SIGMAS,
    keys: list[str] = KEYS, ts: str = "timestamp", seq: str = "seq",
) -> DataFrame:
    """Z-score of every event's running count against the `history` running counts before it.

    Events count in time order. Beyond position `history` the values before an event are the
    run right below it, whose score is one constant below three, so this check sees window
    roll-overs rather than spikes: use zscore_windows for alerting.
    """
    scores = _history_scores(events, duration_ms, history, sigmas, keys, ts)
    ranked = running_counts(events, duration_ms, keys, ts, seq)
    steady = ((history + 1) / 2) / (((history**2 - 1) / 12) ** 0.5)
    return (
        ranked.join(scores, [*keys, "window_start", "running_count"], "left")
        .withColumn("z_score", F.coalesce("z_score", F.lit(steady)))
        .withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(steady > sigmas)))
    )


def running_anomalies(
    events: DataFrame, duration_ms: int = MINUTE, history: int = RUNNING_HISTORY, sigmas: float = SIGMAS,
    keys: list[str] = KEYS, ts: str = "timestamp",
) -> DataFrame:
    """Just the flagged (window, position) pairs: needs window counts only, no event ordering."""
    return _history_scores(events, duration_ms, history, sigmas, keys, ts).where("is_anomaly")


def anomaly_burst(scored: DataFrame, step_ms: int = HOUR, limit: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """Flagged rows per step (and `keys`), and whether there are more than `limit` of them; steps without any are left out."""
    step = floor_ms("window_start", step_ms).alias("step_start")
    counts = scored.where("is_anomaly").groupBy(*keys, step).agg(F.count("*").alias("anomalies"))
    return counts.withColumn("breach", F.col("anomalies") > limit)


def anomaly_signals(scored: DataFrame, value: str = "count") -> DataFrame:
    """Flagged rows as signals; their severity is always a warning."""
    return scored.where("is_anomaly").select(
        "tenant_id",
        "event_type",
        *[c for c in ("window_start", "window_end", "history_avg") if c in scored.columns],
        anomaly_message("event_type", "z_score").alias("message"),
        "z_score",
        F.col(value).cast("double").alias("current_value"),
        F.lit("warning").alias("severity"),
    )
