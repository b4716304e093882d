"""Exact order statistics without sorting or gathering the whole column.

``order_statistics`` narrows a value band with equal-width histograms: each pass is one
distributed ``groupBy(bucket).count()`` over the rows still in the band (map-side partial
counts, at most ``bins`` groups come back), so a pass over N spread-out rows leaves about
N / bins of them, and the pass ends a rank whose bucket holds a single distinct value.  The
driver only ever sees ``bins`` counts, whatever the size.  Each pass puts a band's minimum and
maximum in different buckets, so the narrowing always ends: integers are bucketed in decimal
arithmetic, infinite values get buckets of their own.

``bracketed_statistics`` reads its input twice, whatever its size: a mergeable quantile sketch
gives a narrow bracket around every rank, and one grouped count tells how many values lie below
it and which lie inside; the narrowing then works on these alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strider.session import materialize

DEFAULT_BINS = 4096
#: Size of the quantile sketch, and the share of the rows added to a bracket on either side:
#: about twice the sketch's rank error at 99 % confidence.  A miss is noticed and narrowed anew.
SKETCH_K, MARGIN = 4096, 0.002


def _numeric(df: DataFrame, col: str, *more: str) -> DataFrame:
    x = F.col(col)
    return df.select(col, *more).where(x.isNotNull() & ~F.isnan(x.cast("double")))


def _bucket(x: Column, lo, hi, bins: int) -> Column:
    """Bucket 0 to ``bins - 1`` of ``x`` in the band from ``lo`` to ``hi`` (lo < hi), in order."""
    if isinstance(lo, int):
        wide = "decimal(20,0)"
        share = (x.cast(wide) - F.lit(lo).cast(wide)) * F.lit(bins).cast("decimal(10,0)")
        return F.call_function("div", share, F.lit(str(hi - lo + 1)).cast("decimal(21,0)")).cast("int")
    lo, hi, x = float(lo), float(hi), x.cast("double")
    if math.isinf(lo) or math.isinf(hi):
        return F.when(x == float("-inf"), 0).when(x == float("inf"), 2).otherwise(1)
    if math.isinf(hi - lo):
        lo, hi, x = lo / 2, hi / 2, x / 2
    return F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")


def order_statistics(df: DataFrame, col: str, ks, bins: int = DEFAULT_BINS,
                     weight: str | None = None) -> tuple[int, dict]:
    """Exact k-th smallest values (0-based) of numeric ``col`` for every k in ``ks``.

    ``ks`` is a list of ranks or a function of the value count returning one.  A row counts as
    often as ``weight`` (a column) says.

    Returns ``(n, {k: (value, n_less)})`` where ``n`` counts non-null values and
    ``n_less`` is how many values are strictly smaller than ``value``.  The first
    aggregate (min, max, count) and every pass are shared by all ranks in a band.
    """
    x = F.col(col)
    data = _numeric(df, col, *([weight] if weight else []))
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    first = data.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), rows.alias("n")).first()
    n = int(first["n"] or 0)
    wanted = sorted({k for k in (ks(n) if callable(ks) else ks) if 0 <= k < n})
    out: dict = {}
    # Each pending band: (predicate, lo, hi, below, ranks inside it)
    pending = [(F.lit(True), first["lo"], first["hi"], 0, wanted)] if wanted else []
    while pending:
        band, lo, hi, below, ranks = pending.pop()
        if lo == hi:
            out.update({k: (lo, below) for k in ranks})
            continue
        bucket = _bucket(x, lo, hi, max(bins, 3))
        hist = (data.where(band).groupBy(bucket.alias("b"))
                .agg(rows.alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
                .orderBy("b").collect())
        start = below
        for row in hist:
            inside = [k for k in ranks if start <= k < start + row["n"]]
            if inside:
                pending.append((band & (bucket == row["b"]), row["lo"], row["hi"], start, inside))
            start += row["n"]
    return n, out


def _brackets(spark, sketch: bytes, n: int, ranks: list[int], lo: float, hi: float) -> list[tuple[float, float]]:
    """Value brackets around the ranks, in order and apart from each other."""
    ends = [((k / n - MARGIN), ((k + 1) / n + MARGIN)) for k in ranks]
    asked = [min(max(x, 0.0), 1.0) for pair in ends for x in pair]
    values = spark.range(1).select(F.kll_sketch_get_quantile_double(
        F.lit(bytes(sketch)), F.array(*[F.lit(x) for x in asked]))).first()[0]
    out: list[tuple[float, float]] = []
    for i, (a, b) in enumerate(ends):
        pair = (values[2 * i] if a > 0 else lo, values[2 * i + 1] if b < 1 else hi)
        if out and pair[0] <= out[-1][1]:
            pair = (out[-1][0], max(pair[1], out.pop()[1]))
        out.append(pair)
    return out


def bracketed_statistics(df: DataFrame, col: str, ks, bins: int = DEFAULT_BINS) -> tuple[int, dict]:
    """What ``order_statistics`` returns, with two scans of ``df``.

    The distinct values inside the brackets (about 0.4 % of the rows per rank, counted before
    the shuffle) are checkpointed; at most ``bins`` of them are taken to the driver, more are
    narrowed there.  A rank that its bracket misses is selected by ``order_statistics``.
    """
    data, x = _numeric(df, col), F.col(col)
    wide = x.cast("double")
    first = data.agg(F.count(F.lit(1)).alias("n"), F.min(wide).alias("lo"), F.max(wide).alias("hi"),
                     F.kll_sketch_agg_double(wide, F.lit(SKETCH_K)).alias("sketch")).first()
    n = int(first["n"])
    wanted = sorted({k for k in (ks(n) if callable(ks) else ks) if 0 <= k < n})
    if not wanted:
        return n, {}
    zone = F.lit(0)
    inside = F.lit(False)
    for i, (lo, hi) in enumerate(_brackets(df.sparkSession, first["sketch"], n, wanted, first["lo"], first["hi"])):
        within = wide.between(lo, hi)
        zone = F.when(wide > hi, 2 * i + 2).when(within, 2 * i + 1).otherwise(zone)
        inside = inside | within
    counted = materialize(data.groupBy(zone.alias("zone"), F.when(inside, x).alias("value"))
                          .agg(F.count(F.lit(1)).alias("n")))
    zones = counted.groupBy("zone").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")).orderBy("zone").collect()
    out: dict = {}
    start = 0
    for z in zones:
        mine = [k for k in wanted if start <= k < start + z["n"]]
        rows = counted.where(F.col("zone") == z["zone"])
        if mine and z["zone"] % 2 == 0:
            out.update(order_statistics(df, col, mine, bins)[1])
        elif mine and z["values"] <= bins:
            below = start
            for value, times in rows.select("value", "n").orderBy("value").collect():
                out.update({k: (value, below) for k in mine if below <= k < below + times})
                below += times
        elif mine:
            found = order_statistics(rows, "value", [k - start for k in mine], bins, weight="n")[1]
            out.update({k + start: (value, less + start) for k, (value, less) in found.items()})
        start += z["n"]
    return n, out


def kth_smallest(df: DataFrame, col: str, k: int, bins: int = DEFAULT_BINS):
    """k-th smallest (0-based) non-null value of numeric ``col``; None if out of range."""
    _, stats = order_statistics(df, col, [k], bins)
    return stats[k][0] if k in stats else None


def exact_quantile(df: DataFrame, col: str, p: float, **kw) -> float | None:
    """Quantile with linear interpolation between order statistics (``quantile_cont``)."""
    def ranks(n: int) -> list[int]:
        h = (n - 1) * p
        return [math.floor(h), math.ceil(h)]
    n, stats = bracketed_statistics(df, col, ranks, **kw)
    if n == 0:
        return None
    h = (n - 1) * p
    lo_i, hi_i = math.floor(h), math.ceil(h)
    v_lo, v_hi = float(stats[lo_i][0]), float(stats[hi_i][0])
    return v_lo if hi_i == lo_i else v_lo + (h - lo_i) * (v_hi - v_lo)


def kth_row(df: DataFrame, order_cols: list[str], k: int, **kw) -> tuple | None:
    """Key tuple of the k-th row (0-based) in ``order_cols`` order (total order assumed)."""
    prefix: Column = F.lit(True)
    key = []
    rank = k
    for c in order_cols:
        _, stats = order_statistics(df.where(prefix), c, [rank], **kw)
        if rank not in stats:
            return None
        value, n_less = stats[rank]
        key.append(value)
        rank -= n_less
        prefix = prefix & (F.col(c) == F.lit(value))
    return tuple(key)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed; empty bins shown.

    ``min`` and ``max`` come from one aggregate row (a bounded fit, applied as
    literals); the counts are one grouped count with map-side partial aggregation, and
    the bin grid (``bins`` rows) is generated, not collected.
    """
    x = F.col(col).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    lo, hi = values.agg(F.min("x"), F.max("x")).first()
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return grid.select("bin", F.lit(None).cast("double").alias("bin_start"),
                           F.lit(None).cast("double").alias("bin_end"), F.lit(0).cast("long").alias("count"))
    span = hi - lo
    b = (F.lit(1) if span == 0 else
         F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(span) * bins) + 1, F.lit(bins))).cast("int")
    counts = values.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return (grid.join(F.broadcast(counts), "bin", "left")    # at most `bins` rows
            .select("bin",
                    (F.lit(lo) + (F.col("bin") - 1) * F.lit(span) / bins).alias("bin_start"),
                    (F.lit(lo) + F.col("bin") * F.lit(span) / bins).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))
