"""Grouped and global aggregates behind the exploration pages."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.operators.quantiles import quantiles

PRICE = "sold_price"


def count_mean(df: DataFrame, key: str | list[str], price: str = PRICE) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count("*").alias("count"), F.avg(price).alias("mean"))


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Share of each group; the total is a scalar over the same small aggregate."""
    counts = df.groupBy(key).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", F.col("count") / total)


def cardinality(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, as rows (feature, n_unique)."""
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return one.unpivot([], columns, "feature", "n_unique")
    # Distinct per column: duplicates collapse before the shuffle, values spread over all tasks.
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    seen = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.lit(1).alias("one"))
    return seen.groupBy("feature").agg(F.count("*").alias("n_unique"))


def unique_values(df: DataFrame, features: list[str]) -> DataFrame:
    """Distinct values per feature (NULL included) as rows (feature, value)."""
    absent = [f for f in features if f not in df.columns]
    if absent:
        raise KeyError(f"no columns {absent}")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in features]).unpivot([], features, "feature", "value")
    return long.distinct()


def nice_step(low: float, high: float, max_bins: int) -> float:
    """Smallest step of the form {1, 2, 5} x 10^k that needs at most max_bins bins.

    Bins start at a multiple of the step, so a range that is not aligned can need
    one bin more than its width suggests; such a step is passed over.
    """
    if high <= low:
        return 1.0
    exponent = math.floor(math.log10((high - low) / max_bins))
    for power in range(exponent - 1, exponent + 3):
        for unit in (1, 2, 5):
            step = unit * 10.0**power
            if math.ceil(high / step) - math.floor(low / step) <= max_bins:
                return step
    raise AssertionError("a step always exists")


def bin_start(value: Column, step: float) -> Column:
    """Lower edge of the bin that holds the value (multiplied out to stay exact for 1/k steps)."""
    if step >= 1:
        return F.floor(value / F.lit(float(step))) * F.lit(float(step))
    inverse = float(round(1 / step))
    return F.floor(value * F.lit(inverse)) / F.lit(inverse)


def data_step(df: DataFrame, column: str, max_bins: int) -> float:
    low, high = df.agg(F.min(column), F.max(column)).first()
    return nice_step(float(low), float(high), max_bins) if low is not None else 1.0


def histogram(df: DataFrame, column: str, max_bins: int = 400, step: float | None = None) -> DataFrame:
    step = step or data_step(df, column, max_bins)
    return df.groupBy(bin_start(F.col(column), step).alias("bin")).agg(F.count("*").alias("count"))


def binned_mean(
    df: DataFrame, column: str, price: str = PRICE, max_bins: int = 20, step: float | None = None
) -> DataFrame:
    step = step or data_step(df, column, max_bins)
    return df.groupBy(bin_start(F.col(column), step).alias("bin")).agg(
        F.count("*").alias("count"), F.avg(price).alias("mean")
    )


def mean_ci(df: DataFrame, key: str, price: str = PRICE, z: float = 1.96) -> DataFrame:
    """Group mean with a normal-approximation confidence interval."""
    stats = df.groupBy(key).agg(
        F.count("*").alias("count"), F.avg(price).alias("mean"), F.stddev_samp(price).alias("__sd")
    )
    half = F.lit(z) * F.col("__sd") / F.sqrt("count")
    return stats.select(key, "count", "mean", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


WEIGHT_SLOTS = 1024


def poisson_weights(slots: int = WEIGHT_SLOTS) -> list[int]:
    """Poisson(1) counts laid out over equally likely slots."""
    out, k, p, cumulative = [], 0, math.exp(-1), math.exp(-1)
    for slot in range(slots):
        while (slot + 0.5) / slots > cumulative:
            k += 1
            p /= k
            cumulative += p
        out.append(k)
    return out


def mean_ci_bootstrap(
    df: DataFrame, key: str, row_key: Column, price: str = PRICE, replicates: int = 100, seed: int = 42
) -> DataFrame:
    """Bootstrap interval of the group mean with Poisson(1) row weights.

    The weights are drawn from a hash of the row key, so the result does not
    depend on partitioning. All replicates are columns of one aggregate: rows
    are never multiplied.
    """
    # a constant that folds to one array literal
    weights = F.split(F.lit(",".join(map(str, poisson_weights()))), ",").cast("array<int>")

    def weight(r: int) -> Column:
        draw = F.pmod(F.xxhash64(row_key, F.lit(seed), F.lit(r)), F.lit(WEIGHT_SLOTS)).cast("int")
        return F.get(weights, draw)

    weighted = df.select(key, price, *[weight(r).alias(f"__w{r}") for r in range(replicates)])
    aggregates = [F.count("*").alias("count"), F.avg(price).alias("mean")]
    for r in range(replicates):
        total = F.sum(F.col(f"__w{r}") * F.col(price)).cast("double")
        aggregates.append(F.try_divide(total, F.sum(f"__w{r}")).alias(f"__b{r}"))
    means = weighted.groupBy(key).agg(*aggregates)
    ordered = F.array_sort(F.filter(F.array(*[f"__b{r}" for r in range(replicates)]), lambda m: m.isNotNull()))
    low = F.greatest(F.lit(1), F.floor(F.size(ordered) * 0.025).cast("int") + 1)
    high = F.least(F.size(ordered), F.ceil(F.size(ordered) * 0.975).cast("int"))
    return means.select(
        key, "count", "mean", F.try_element_at(ordered, low).alias("ci_low"), F.try_element_at(ordered, high).alias("ci_high")
    )


def trend(points: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Least-squares line through (x, y) points, unweighted."""
    return points.groupBy(*(by or [])).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept")
    )


def power_sums(df: DataFrame, x: str, y: str, center: float = 0.0) -> DataFrame:
    """The sums a quadratic fit needs, from one pass."""
    xc = F.col(x).cast("double") - F.lit(center)
    yv = F.col(y).cast("double")
    return df.agg(
        F.count("*").alias("n"),
        *[F.sum(F.pow(xc, F.lit(p))).alias(f"x{p}") for p in (1, 2, 3, 4)],
        F.sum(yv).alias("y"),
        F.sum(xc * yv).alias("xy"),
        F.sum(xc * xc * yv).alias("x2y"),
    )


def trend_poly2(df: DataFrame, x: str, y: str, center: float = 0.0) -> DataFrame:
    """Quadratic least squares of y on x - center; one row (c0, c1, c2).

    The 3x3 normal equations are solved with Cramer's rule inside the plan.
    """
    s = power_sums(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), x, y, center)
    n, x1, x2, x3, x4, y0, xy, x2y = (F.col(c).cast("double") for c in ("n", "x1", "x2", "x3", "x4", "y", "xy", "x2y"))

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    base = det(n, x1, x2, x1, x2, x3, x2, x3, x4)
    return s.select(
        F.try_divide(det(y0, x1, x2, xy, x2, x3, x2y, x3, x4), base).alias("c0"),
        F.try_divide(det(n, y0, x2, x1, xy, x3, x2, x2y, x4), base).alias("c1"),
        F.try_divide(det(n, x1, y0, x1, x2, xy, x2, x3, x2y), base).alias("c2"),
    )


def rule_of_thumb_bandwidth(df: DataFrame, column: str) -> float:
    """1.06 min(sd, iqr / 1.34) n^(-1/5)."""
    n, sd = df.agg(F.count(column), F.stddev_samp(column)).first()
    if n == 0:
        raise ValueError(f"{column!r} has no values to take a bandwidth from")
    q = quantiles(df, [0.25, 0.75], column)
    spread = (q[0.75] - q[0.25]) / 1.34
    width = min(sd or 0.0, spread) or sd or abs(q[0.25]) or 1.0
    return 1.06 * width * n**-0.2


def group_bandwidths(counted: DataFrame, by: str) -> DataFrame:
    """(by, __h): the rule of thumb for every group of (by, __v, __n) value counts at once.

    Quartiles are read off running counts of the ordered values, so any number
    of groups and any size of group takes the same few jobs. NULL is a group.
    """
    from pricewright.operators.windows import running

    rows, mean = F.sum("__n"), F.sum(F.col("__v") * F.col("__n")) / F.sum("__n")
    totals = counted.groupBy(F.col(by).alias("__by")).agg(rows.alias("__rows"), mean.alias("__mean"))
    same = F.col(by).eqNullSafe(F.col("__by"))
    upto = running(counted, [by], ["__v"], {"__upto": ("sum", F.col("__n"))}).join(totals, same)

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("__upto") > rank, F.col("__v")))

    def quartile(q: float) -> tuple[Column, Column, Column]:
        place = F.lit(q) * (F.col("__rows") - 1)
        return at(F.floor(place)), at(F.ceil(place)), F.first(place - F.floor(place))

    off = F.col("__v") - F.col("__mean")
    ends = [c for q in (0.25, 0.75) for c in quartile(q)]
    found = upto.groupBy(by).agg(
        F.sum("__n").alias("__rows"),
        F.sum(off * off * F.col("__n")).alias("__squares"),
        *[c.alias(f"__e{k}") for k, c in enumerate(ends)],
    )
    low, high = (F.col(f"__e{k}") + F.col(f"__e{k + 2}") * (F.col(f"__e{k + 1}") - F.col(f"__e{k}")) for k in (0, 3))
    sd = F.sqrt(F.try_divide(F.col("__squares"), F.col("__rows") - 1))
    width = F.coalesce(
        F.nullif(F.least(sd, (high - low) / 1.34), F.lit(0.0)), F.nullif(sd, F.lit(0.0)), F.nullif(F.abs(low), F.lit(0.0)), F.lit(1.0)
    )
    return found.select(by, (F.lit(1.06) * width * F.pow("__rows", F.lit(-0.2))).alias("__h"))


def density(
    df: DataFrame, column: str, by: str, grid: list[float], bandwidth: float | dict[str, float] | None = None
) -> DataFrame:
    """Gaussian kernel density per group on a fixed grid.

    Equal values are counted first, so a hot value costs one evaluation per grid
    point; the evaluations are summed on the map side into groups x grid rows.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(by, F.col(column).cast("double").alias("__v"))
        .agg(F.count("*").alias("__n"))
    )
    if bandwidth is None:
        widths = group_bandwidths(counted, by).withColumnRenamed(by, "__by")
        counted = counted.join(widths, F.col(by).eqNullSafe(F.col("__by"))).drop("__by")
    elif isinstance(bandwidth, dict):
        known = {g: h for g, h in bandwidth.items() if g is not None}
        width = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[F.col(by)] if known else F.lit(None).cast("double")
        counted = counted.withColumn("__h", F.when(F.col(by).isNull(), F.lit(bandwidth.get(None))).otherwise(width))
    else:
        counted = counted.withColumn("__h", F.lit(float(bandwidth)))
    points = F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("__g")
    z = (F.col("__v") - F.col("__g")) / F.col("__h")
    kernel = F.exp(F.lit(-0.5) * z * z) * F.col("__n") / (F.col("__h") * F.lit(math.sqrt(2 * math.pi)))
    return (
        counted.select(by, "__v", "__n", "__h", points)
        .groupBy(by, "__g")
        .agg((F.sum(kernel) / F.sum("__n")).alias("density"))
        .withColumnRenamed("__g", column)
    )


def usage_stats(df: DataFrame, days: int | None = None, now: Column | None = None) -> DataFrame:
    """Request totals, mean response time and error rate; no rows in, no rows out."""
    if days is not None:
        now = F.current_timestamp() if now is None else now
        df = df.where(F.col("timestamp") >= now - F.make_dt_interval(F.lit(days)))
    return df.agg(
        F.count("*").alias("total_requests"),
        F.avg("response_time").alias("avg_response_time"),
        F.try_divide(F.lit(100.0) * F.count_if(F.col("status_code") >= 400).cast("double"), F.count("*")).alias("error_rate"),
    ).where(F.col("total_requests") > 0)


def endpoint_usage(df: DataFrame) -> DataFrame:
    return df.groupBy("request_path").agg(F.count("*").alias("requests"))


def evaluate(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None, rounded: bool = False) -> DataFrame:
    """RMSLE and WAPE in one aggregate; a negative value fails the job."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    ok = F.when((y < 0) | (p < 0), F.raise_error(F.lit("RMSLE needs non-negative values")).cast("double"))
    gap = F.coalesce(ok, F.log1p(y) - F.log1p(p))
    rmsle = F.sqrt(F.avg(gap * gap))
    wape = F.try_divide(F.sum(F.abs(y - p)), F.sum(y))
    if rounded:
        rmsle, wape = F.bround(rmsle, 3), F.bround(wape, 2)
    return df.groupBy(*(by or [])).agg(rmsle.alias("rmsle"), wape.alias("wape"))


def median_baseline(train: DataFrame, df: DataFrame, price: str = PRICE, output: str = "prediction") -> DataFrame:
    """Predict the training median for every row."""
    median = quantiles(train, [0.5], price)[0.5]
    return df.withColumn(output, F.lit(float(median)))


def before_after(before: DataFrame, after: DataFrame, metric: str = "rmsle_eval") -> DataFrame:
    """Best metric of two sweeps as a two-row table."""
    best = [
        runs.agg(F.min(metric).alias(metric)).select(F.lit(label).alias("tuning"), metric)
        for label, runs in (("before", before), ("after", after))
    ]
    return best[0].unionByName(best[1])


def improvement(runs: DataFrame, baseline: Column | float, metric: str = "rmsle_eval", gate: float = 0.01) -> DataFrame:
    """Gain over a baseline in percent, and whether it passes the significance gate."""
    base = baseline if isinstance(baseline, Column) else F.lit(float(baseline))
    gain = base - F.col(metric)
    return runs.withColumns({"improvement_pct": F.lit(100.0) * gain / base, "is_significant": gain >= F.lit(gate)})
