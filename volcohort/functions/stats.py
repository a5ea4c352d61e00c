"""Statistics as column expressions and small aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def nan_mean(c: Column, digits: int = 4) -> Column:
    return F.round(F.avg(F.when(~F.isnan(c), c)), digits)


def nan_std(c: Column, digits: int = 4) -> Column:
    """Population deviation; NULL for fewer than two values."""
    x = F.when(~F.isnan(c), c)
    return F.when(F.count(x) > 1, F.round(F.stddev_pop(x), digits))


def tukey(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, lo, hi: quartile fences, NULL for groups under four rows."""
    q = df.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.count(value).alias("n"))
    spread = 1.5 * (F.col("q")[1] - F.col("q")[0])
    return q.select(*keys, "n", F.when(F.col("n") >= 4, F.col("q")[0] - spread).alias("lo"), F.when(F.col("n") >= 4, F.col("q")[1] + spread).alias("hi"))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Score interval of a share in per cent; (0, 0) without rows."""
    p = k / n
    d = 1 + z * z / n
    mid, half = (p + z * z / (2 * n)) / d, z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    low, high = F.greatest(F.lit(0.0), mid - half), F.least(F.lit(1.0), mid + half)
    return F.when(n > 0, 100 * low).otherwise(0.0), F.when(n > 0, 100 * high).otherwise(0.0)


def ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add `_r` (rank from 0) and `_n` (size) by value within keys."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_r", F.row_number().over(w.orderBy(value)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))


def median_interval(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, median, lo, hi: median +- 1.58 IQR / sqrt(n), from eight values on. The median is v[n // 2], the quartiles are
    v[int(f (n - 1))] of the ordered values."""
    r = ranked(df.where(F.col(value).isNotNull()), keys, value)
    at = lambda place: F.max(F.when(F.col("_r") == F.floor(place), F.col(value)))
    n = F.col("_n")
    out = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), at(0.25 * (n - 1)).alias("a"), at(n / 2).alias("median"), at(0.75 * (n - 1)).alias("b")).where("n >= 8")
    half = 1.58 * (F.col("b") - F.col("a")) / F.sqrt("n")
    return out.select(*keys, "n", "median", (F.col("median") - half).alias("lo"), (F.col("median") + half).alias("hi"))


def middle(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, median: v[n // 2] of the ordered values of each key, exactly. A mergeable sketch bounds where it lies, with room for
    the sketch's error; only the values between the bounds, a tenth, are ordered, and equal ones are counted before."""
    v = F.col(value).cast("double")
    own = df.where(v.isNotNull()).select(*keys, v.alias("_v"))
    bounds = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", [0.45, 0.55], 1000).alias("_b"))
    bounds = bounds.withColumn("_wide", F.col("n") < 40)  # so few that the bounds may be ranks away
    low, high = F.when(~F.col("_wide"), F.col("_b")[0]).otherwise(float("-inf")), F.when(~F.col("_wide"), F.col("_b")[1]).otherwise(float("inf"))
    counted = own.join(bounds.select(*keys, "n", low.alias("_lo"), high.alias("_hi")), keys).where("_v <= _hi")
    counted = counted.groupBy(*keys, F.when(F.col("_v") < F.col("_lo"), F.lit(None)).otherwise(F.col("_v")).alias("_v")).agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("_c"))
    seen = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")))
    found = counted.withColumn("_seen", seen).where((F.col("_seen") > F.floor(F.col("n") / 2)) & F.col("_v").isNotNull())
    return found.groupBy(*keys).agg(F.first("n").alias("n"), F.min("_v").alias("median"))


def quantile(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """keys, n, quantile: the value at place q (n - 1) of each key's ordered values, exactly, between two places by the line through
    both. As in `middle`, only values between the bounds of a mergeable sketch are ordered."""
    v = F.col(value).cast("double")
    own = df.where(v.isNotNull()).select(*keys, v.alias("_v"))
    bounds = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", [max(0.0, q - 0.05), min(1.0, q + 0.05)], 1000).alias("_b"))
    some = F.col("n") >= 40
    low = F.when(some & F.lit(q > 0.05), F.col("_b")[0]).otherwise(float("-inf"))
    high = F.when(some & F.lit(q < 0.95), F.col("_b")[1]).otherwise(float("inf"))
    counted = own.join(bounds.select(*keys, "n", low.alias("_lo"), high.alias("_hi")), keys).where("_v <= _hi")
    counted = counted.groupBy(*keys, F.when(F.col("_v") < F.col("_lo"), F.lit(None)).otherwise(F.col("_v")).alias("_v")).agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("_c"))
    counted = counted.withColumn("_seen", F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")))).where("_v is not null")
    place = (F.col("n") - 1) * F.lit(q)
    at = lambda p: F.min(F.when(F.col("_seen") > p, F.col("_v")))
    found = counted.groupBy(*keys).agg(F.first("n").alias("n"), at(F.floor(place)).alias("_a"), at(F.ceil(place)).alias("_b"))
    return found.select(*keys, "n", (F.col("_a") + (F.col("_b") - F.col("_a")) * (place - F.floor(place))).alias("quantile"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) of equal bins over [low, high]; the last holds its upper edge; values outside are left out."""
    width = (high - low) / bins
    b = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    return df.where(F.col(value).between(low, high)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


#: Bins of a pass of `nth`, and rows that are few enough to be ordered in one task.
PASS_BINS, FEW = 4096, 10_000
#: Distinct values beyond which values aren't steps of an instrument.
MOST_STEPS = 100_000


def nth(df: DataFrame, value: str, places: list[int]) -> list[float]:
    """The values at these places (from 0) of the order of all rows, without bringing the rows into one order: each pass counts
    equal bins and goes on within the bins of the places, until few rows or one value are left. Places share the passes."""
    x, found = F.col(value).cast("double"), {}
    todo = [(df.where(x.isNotNull()).select(x.alias("v")), 0, sorted(set(places)))] if places else []
    while todo:
        part, before, asked = todo.pop()
        ends = part.agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count(F.lit(1)).alias("n")).first()
        if ends["a"] == ends["b"]:
            found |= dict.fromkeys(asked, ends["a"])
            continue
        if ends["n"] <= FEW:
            held = sorted(r["v"] for r in part.collect())
            found |= {p: held[p - before] for p in asked}
            continue
        width = (ends["b"] - ends["a"]) / PASS_BINS
        bin_ = F.least(F.floor((F.col("v") - ends["a"]) / width), F.lit(PASS_BINS - 1))
        for r in sorted(part.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()):  # PASS_BINS rows at most
            here = [p for p in asked if before <= p < before + r["n"]]
            if here:
                todo.append((part.where(bin_ == r["bin"]), before, here))
            before += r["n"]
    return [found[p] for p in places]


def robust_bandwidth(df: DataFrame, value: str, low: float, high: float) -> tuple[int, float | None]:
    """(n, bandwidth) for the values in [low, high]: Silverman's rule with the lesser of deviation and IQR / 1.34, narrowed for
    200 values or more, widened under 100, and no less than 1.5 steps where values are steps; no bandwidth under eight values."""
    kept = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").between(low, high))
    got = kept.agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd")).first()
    n, sd = got["n"], got["sd"] or 0.0
    if n < 8:
        return n, None
    q1, q3 = nth(kept, "v", [int(0.25 * (n - 1)), int(0.75 * (n - 1))])
    scale = min(sd, (q3 - q1) / 1.34) if q3 > q1 else sd
    scale = scale if scale > 0 else sd or (high - low) / 50
    h = (0.85 if n >= 200 else 1.0 if n >= 100 else 1.15) * 0.9 * scale * n**-0.2
    steps = kept.select(F.round("v", 4).alias("v")).distinct()
    many = steps.limit(min(MOST_STEPS, math.ceil(0.4 * n)) + 1).count()
    if 4 < many < 0.4 * n and many <= MOST_STEPS:
        gaps = steps.select(F.round(F.lead("v").over(Window.orderBy("v")) - F.col("v"), 4).alias("g")).where("g > 0")
        h = max(h, 1.5 * nth(gaps, "g", [(many - 1) // 2])[0])
    return n, h


def reflected_kde(df: DataFrame, value: str, low: float, high: float, points: int = 220, bandwidth: float | None = None) -> DataFrame:
    """(point, x, density): a Gaussian kernel estimate on a grid, reflected at both bounds, by the robust bandwidth unless one is
    given; no rows under eight values. Values are counted first; each task adds its own up by point before the shuffle."""
    n, robust = robust_bandwidth(df, value, low, high)
    h = bandwidth or robust
    if robust is None:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    v = F.col("v")
    counted = df.where(F.col(value).between(low, high)).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    grid = counted.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", F.lit(low) + F.col("point") * ((high - low) / (points - 1)))
    near = lambda q: F.when(F.abs((F.col("x") - q) / h) < 5, F.exp(-0.5 * F.pow((F.col("x") - q) / h, F.lit(2)))).otherwise(0.0)
    out = grid.groupBy("point").agg(F.max("x").alias("x"), F.sum(F.col("c") * (near(v) + near(2 * low - v) + near(2 * high - v))).alias("s"))
    return out.select("point", "x", (F.col("s") / (n * h * math.sqrt(2 * math.pi))).alias("density"))


def log_factorial(n: Column) -> Column:
    """log(n!) of a whole number: exact values up to 31, beyond it Stirling's series, whose next term is under 1e-13."""
    x = n.cast("double")
    few = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(32)])
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 32, F.get(few, n)).otherwise(series)


def fisher(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided exact p of a 2 x 2 table of counts: all tables of the same margins that are no likelier.

    It looks at every such table; use it for tables, of which there are few, not for rows."""
    a, b, c, d = (x.cast("int") for x in (a, b, c, d))
    logs = log_factorial
    r1, r2, c1 = a + b, c + d, a + c
    chance = lambda x: logs(r1) - logs(x) - logs(r1 - x) + logs(r2) - logs(c1 - x) - logs(r2 - c1 + x) - logs(r1 + r2) + logs(c1) + logs(r1 + r2 - c1)
    own = chance(a)
    each = F.transform(F.sequence(F.greatest(F.lit(0), c1 - r2), F.least(r1, c1)), lambda x: F.exp(chance(x)))
    return F.least(F.lit(1.0), F.aggregate(F.filter(each, lambda p: p <= F.exp(own) * (1 + 1e-7)), F.lit(0.0), lambda s, p: s + p))


def auc(df: DataFrame, keys: list[str], score: str, positive: str, tie: str) -> DataFrame:
    """keys, n_pos, n_neg, auc: Mann-Whitney by ordinal rank; ties go by `tie`.

    Ranks are per key: give keys, as a rank over all rows needs them in one order."""
    r = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(score, tie)))
    out = r.groupBy(*keys).agg(F.sum(F.col(positive).cast("long")).alias("n_pos"), F.sum((~F.col(positive)).cast("long")).alias("n_neg"), F.sum(F.when(F.col(positive), F.col("_r")).otherwise(0)).alias("s"))
    return out.select(*keys, "n_pos", "n_neg", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), (F.col("s") - F.col("n_pos") * (F.col("n_pos") + 1) / 2) / (F.col("n_pos") * F.col("n_neg"))).alias("auc"))
