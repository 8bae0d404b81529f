"""Tumbling and sliding windows over events.

Metrics of a window are count, sum, average and the exact 99th percentile (nearest rank). The
percentile of a window cannot be merged from percentiles, and a hot window may hold a large part
of all rows, so it is found by narrowing instead of by gathering the values:

1. Events are reduced to cells, one per (key, base window, value band), holding count, sum, lowest
   and highest value. Bands follow the logarithm of the value, so their number per window depends
   on the value range only. This step combines on the map side.
2. Cells, not events, are copied into every window length and summed. Windows of fewer than 100
   events (or of one value) are finished: the percentile is their maximum.
3. For the larger ones, running counts over their bands find the band with the wanted rank. If the
   rank is the lowest or highest of the band, or the band has one value, they are finished too.
4. For the rest, only events of the wanted bands are read back and counted by value. The band is cut into
   equal parts between its lowest and highest value, running counts find the part, and only the values of
   that part are ranked, so a hot window is not ranked by one task.

Steps 2 and 3 read the same exchange of cells; a stage without any window is skipped at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import MINUTE, SECOND, TUMBLING, floor_ms

KEYS = ["tenant_id", "event_type"]
BANDS_PER_E = 32
PARTS_PER_BAND = 4096
PERCENT = 99


def value_band(value: str, bands: int = BANDS_PER_E) -> Column:
    """Order-preserving band of a double: log1p is monotonic, so is its floor."""
    return F.expr(f"try_cast(signum({value}) * floor(log1p(abs({value})) * {bands}) as bigint)")


def explode_windows(df: DataFrame, durations: dict[str, int], ts: str) -> DataFrame:
    """One row per window length, with `window_type` and `window_start`."""
    entries = ", ".join(
        f"named_struct('window_type', '{name}', 'window_start', {ts} - pmod({ts}, {ms}L))"
        for name, ms in durations.items()
    )
    return df.selectExpr("*", f"inline(array({entries}))")


def _length(durations: dict[str, int]) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {ms}L" for name, ms in durations.items())
    return f"CASE window_type {cases} END"


def countable(df: DataFrame, keys: list[str], ts: str, value: str, weight: str | None) -> DataFrame:
    """The columns that windows need, so that every event with a time counts.

    A value that is null or not finite counts as 1.0, like one that is no number; a null text key is empty.
    """
    finite = F.when(F.col(value).cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308), F.col(value))
    named = [F.coalesce(F.col(k), F.lit("")).alias(k) if dict(df.dtypes)[k] == "string" else F.col(k) for k in keys]
    columns = [*named, F.col(ts), F.coalesce(finite, F.lit(1.0)).alias(value), *([F.col(weight)] if weight else [])]
    return df.select(*columns).where(F.col(ts).isNotNull())


def _cells(
    df: DataFrame, keys: list[str], base_ms: int, ts: str, value: str, weight: str | None, bands: int
) -> DataFrame:
    n, s = ("count(*)", f"sum({value})") if weight is None else (f"sum({weight})", f"sum({value} * {weight})")
    aggs = {"_n": n, "_s": s, "_lo": f"min({value})", "_hi": f"max({value})"}
    return (
        df.select("*", floor_ms(ts, base_ms).alias("_base"), value_band(value, bands).alias("_band"))
        .groupBy(*keys, "_base", "_band")
        .agg(*[F.expr(f"{e} AS {name}") for name, e in aggs.items()])
    )


def _locate(cells: DataFrame, large: DataFrame, group: list[str], percent: int) -> DataFrame:
    """Totals, and the band, bounds and in-band rank of the percentile, of the large windows.

    The final aggregation has the partitioning of the window functions, so it adds no shuffle.
    """
    part = ", ".join(group)
    up = f"OVER (PARTITION BY {part} ORDER BY _band RANGE BETWEEN UNBOUNDED PRECEDING AND"
    ranked = cells.join(large.select(*group, "count"), group).selectExpr(
        *group, "count", "_band", "_n", "_lo", "_hi",
        f"sum(_n) {up} CURRENT ROW) AS _upto",
        f"coalesce(sum(_n) {up} 1 PRECEDING), 0) AS _below",
        f"sum(_s) OVER (PARTITION BY {part}) AS sum",
        f"count - (count * {100 - percent}) div 100 AS _rank",
    ).where("_rank > _below AND _rank <= _upto")
    aggs = [
        "max(count) AS count", "max(sum) AS sum", "max(_band) AS _band", "max(_rank - _below) AS _rank",
        "sum(_n) AS _n", "min(_lo) AS _lo", "max(_hi) AS _hi",
    ]
    return ranked.groupBy(*group).agg(*[F.expr(a) for a in aggs])


def _rank_in_band(
    events: DataFrame, open_: DataFrame, keys: list[str], durations: dict[str, int],
    ts: str, value: str, weight: str | None, bands: int,
) -> DataFrame:
    """Finish the windows whose rank lies inside a band.

    The open windows of a key and longest window travel as one array (a few dozen entries at
    most, set by the window lengths), so each event is shuffled once, not once per length.
    """
    longest = max(durations.values())
    fields = "window_type, window_start, count, sum, _band, _rank, _lo, _hi"
    targets = open_.groupBy(*keys, floor_ms("window_start", longest).alias("_parent")).agg(
        F.expr(f"collect_list(struct({fields}, window_start + {_length(durations)} AS _end)) AS _open")
    )
    inside = f"filter(_open, w -> w._band = _eband AND {ts} >= w.window_start AND {ts} < w._end)"
    carried = [*keys, value, *([weight] if weight else [])]
    group = [*keys, "window_type", "window_start", "count", "sum"]
    counts = (
        events.select("*", floor_ms(ts, longest).alias("_parent"), value_band(value, bands).alias("_eband"))
        .join(targets, [*keys, "_parent"])
        .selectExpr(*carried, f"inline({inside})")
        .groupBy(*group, "_rank", "_lo", "_hi", value)
        .agg(F.expr("count(*) AS _n" if weight is None else f"sum({weight}) AS _n"))
    )
    window = [*keys, "window_type", "window_start"]
    narrow = _narrow(counts, group, window, value)
    upto = f"sum(_n) OVER (PARTITION BY {', '.join(window)} ORDER BY {value}) AS _upto"
    return (
        narrow.selectExpr("*", upto)
        .where("_rank <= _upto AND _rank > _upto - _n")
        .selectExpr(*group, f"{value} AS _p")
    )


def _narrow(counts: DataFrame, group: list[str], window: list[str], value: str) -> DataFrame:
    """The value counts of the part of a window's band that holds the rank, and the rank inside that part.

    Parts are equal in width, so equal values share one. Both readers of `counts` use all of its columns and
    join on a struct, which is never null: no filter goes below their common exchange.
    """
    part = f"coalesce(least({PARTS_PER_BAND - 1}L, floor(({value} - _lo) / (_hi - _lo) * {PARTS_PER_BAND})), 0L)"
    placed = counts.selectExpr("*", f"struct({', '.join(window)}, {part} AS part) AS _w")
    up = f"OVER (PARTITION BY {', '.join(window)} ORDER BY _w.part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wanted = (
        placed.groupBy(*group, "_rank", "_lo", "_hi", "_w")
        .agg(F.sum("_n").alias("_n"))
        .selectExpr("_w", "_rank", "_n", f"sum(_n) {up} AS _upto")
        .where("_rank <= _upto AND _rank > _upto - _n")
        .selectExpr("_w", "_upto - _n AS _before")
    )
    return placed.join(wanted, "_w").selectExpr(*group, value, "_n", "_rank - _before AS _rank")


def window_metrics(
    events: DataFrame,
    durations: dict[str, int] = TUMBLING,
    keys: list[str] = KEYS,
    ts: str = "timestamp",
    value: str = "value",
    weight: str | None = None,
    percent: int = PERCENT,
    bands: int = BANDS_PER_E,
) -> DataFrame:
    """count, sum, avg and exact percentile per key and window, for all lengths in one go.

    Lengths must be multiples of the shortest and divide the longest. `weight` says how many
    events a row stands for (rows from a stream's value counts).
    """
    base, longest = min(durations.values()), max(durations.values())
    if any(ms % base or longest % ms for ms in durations.values()):
        raise ValueError("window lengths must nest")
    # Columns without nulls, and using every column of the cells in both readers, keep the two plans
    # identical down to the exchange, so Spark runs it once.
    slim = countable(events, keys, ts, value, weight)
    cells = explode_windows(_cells(slim, keys, base, ts, value, weight, bands), durations, "_base")
    group = [*keys, "window_type", "window_start"]
    totals = cells.groupBy(*group).agg(
        *[F.expr(e) for e in ("sum(_n) AS count", "sum(_s) AS sum", "min(_lo) AS _lo", "max(_hi) AS _hi")]
    )
    big = f"count * {100 - percent} >= 100 AND _lo < _hi AND sum IS NOT NULL"
    located = _locate(cells, totals.where(big), group, percent)
    done = "_rank = _n OR _rank = 1 OR _lo = _hi"
    parts = [
        totals.where(f"NOT ({big})").selectExpr(*group, "count", "sum", "_hi AS _p"),
        located.where(done).selectExpr(
            *group, "count", "sum", "CASE WHEN _rank = _n THEN _hi ELSE _lo END AS _p"
        ),
        _rank_in_band(slim, located.where(f"NOT ({done})"), keys, durations, ts, value, weight, bands),
    ]
    return parts[0].union(parts[1]).union(parts[2]).selectExpr(
        *group,
        f"window_start + {_length(durations)} AS window_end",
        "count",
        "sum",
        "sum / count AS avg",
        f"_p AS p{percent}",
    )


def window_counts(
    events: DataFrame, duration_ms: int, keys: list[str] = KEYS, ts: str = "timestamp"
) -> DataFrame:
    """Just the event count per key and tumbling window."""
    return events.groupBy(*keys, floor_ms(ts, duration_ms).alias("window_start")).agg(
        F.count("*").alias("count")
    )


def counts_by_length(
    events: DataFrame, durations: dict[str, int] = TUMBLING, keys: list[str] = KEYS, ts: str = "timestamp"
) -> DataFrame:
    """Event counts of all window lengths: what `window_metrics` counts, without values.

    Events are counted once, per shortest window; these counts are copied into the longer ones.
    """
    base = min(durations.values())
    if any(ms % base for ms in durations.values()):
        raise ValueError("window lengths must be multiples of the shortest")
    slim = countable(events.withColumn("_one", F.lit(1.0)), keys, ts, "_one", None)
    cells = slim.groupBy(*keys, floor_ms(ts, base).alias("_base")).agg(F.count("*").alias("_n"))
    return (
        explode_windows(cells, durations, "_base")
        .groupBy(*keys, "window_type", "window_start")
        .agg(F.sum("_n").alias("count"))
        .selectExpr(*keys, "window_type", "window_start", f"window_start + {_length(durations)} AS window_end", "count")
    )


def fill_empty(counts: DataFrame, duration_ms: int, keys: list[str] = KEYS, until: Column | None = None) -> DataFrame:
    """Add the windows with zero events between a key's first and last window (or `until`).

    Expands per key to one row per window of its time span, so it is bounded by time.
    """
    spans = counts.groupBy(*keys).agg(F.min("window_start").alias("_a"), F.max("window_start").alias("_b"))
    last = F.col("_b") if until is None else F.greatest(F.col("_b"), until)
    grid = spans.select(
        *keys, F.explode(F.sequence("_a", last, F.lit(duration_ms).cast("bigint"))).alias("window_start")
    )
    return grid.join(counts, [*keys, "window_start"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0).cast("bigint"))
    )


def sliding_counts(
    events: DataFrame,
    size_ms: int = 5 * MINUTE,
    slide_ms: int = 30 * SECOND,
    keys: list[str] = KEYS,
    ts: str = "timestamp",
    value: str | None = None,
) -> DataFrame:
    """Counts (and sums) per sliding window.

    Events are first counted per slide-long pane; only panes, not events, are copied into the
    size/slide windows that contain them.
    """
    if size_ms % slide_ms:
        raise ValueError("the window size must be a multiple of the slide")
    aggs = [F.count("*").alias("_n")] + ([F.sum(value).alias("_s")] if value else [])
    panes = events.groupBy(*keys, floor_ms(ts, slide_ms).alias("_pane")).agg(*aggs)
    step = F.lit(slide_ms).cast("bigint")
    starts = F.sequence(F.col("_pane") - F.lit(size_ms - slide_ms), F.col("_pane"), step)
    spread = panes.withColumn("window_start", F.explode(starts))
    out = [F.sum("_n").alias("count")] + ([F.sum("_s").alias("sum")] if value else [])
    return (
        spread.groupBy(*keys, "window_start")
        .agg(*out)
        .withColumn("window_end", F.col("window_start") + F.lit(size_ms))
    )


def approx_metrics(
    events: DataFrame,
    durations: dict[str, int] = TUMBLING,
    keys: list[str] = KEYS,
    ts: str = "timestamp",
    value: str = "value",
) -> DataFrame:
    """Mergeable partials: count, sum and a KLL sketch per window, for very large windows.

    The same events count with the same values as in `window_metrics`.
    """
    slim = countable(events, keys, ts, value, None)
    base = min(durations.values())
    minute = slim.groupBy(*keys, floor_ms(ts, base).alias("_base")).agg(
        F.count("*").alias("count"), F.sum(value).alias("sum"), F.kll_sketch_agg_double(value).alias("sketch")
    )
    return (
        explode_windows(minute, durations, "_base")
        .groupBy(*keys, "window_type", "window_start")
        .agg(
            F.sum("count").alias("count"),
            F.sum("sum").alias("sum"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
    )


def finish_approx(partials: DataFrame, quantile: float = 0.99) -> DataFrame:
    return partials.withColumn("avg", F.col("sum") / F.col("count")).withColumn(
        "p99", F.kll_sketch_get_quantile_double("sketch", F.lit(quantile))
    ).drop("sketch")
