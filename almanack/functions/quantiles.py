"""Exact quantiles per group without gathering a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here values are first collapsed to (group, value, count).
As long as a group's range holds more distinct values than may be ordered side
by side, it is cut at approximate quantiles of these values and only the cells
that hold a wanted rank are looked into further. The cuts are values of the group,
so every round shrinks its cells, whatever their spread and with infinite values
too; only where cuts lie is approximate. Each step is handed over as a written
table, so tasks run again see the same cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from almanack.session import hand_over

CELLS = 64
ROWS_AT_ONCE = 200_000


VALUE, COUNT = "_v", "_n"


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, VALUE, COUNT): how often each value occurs in its group, null and NaN as
    null, written. What is asked of a distribution follows from this one pass over the data."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
    return hand_over(df.groupBy(*keys, number.alias(VALUE)).agg(F.count("*").alias(COUNT)), "value-counts")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    cells: int = CELLS,
    rows_at_once: int = ROWS_AT_ONCE,
) -> DataFrame:
    """One row per group: the keys and one linearly interpolated column per
    entry of ``quantiles`` (column name -> probability). Nulls and NaN are
    left out, as pandas does; groups without values do not appear. Runs the
    passes over the data when called."""
    return quantiles_of(value_counts(df, keys, value), keys, quantiles, cells, rows_at_once)


def quantiles_of(
    counts: DataFrame,
    keys: Sequence[str],
    quantiles: dict[str, float],
    cells: int = CELLS,
    rows_at_once: int = ROWS_AT_ONCE,
) -> DataFrame:
    """`exact_quantiles` of a frame whose `value_counts` are at hand."""
    keys = list(keys)
    if not keys:
        raise ValueError("at least one grouping column is needed to join on")
    counts = counts.where(F.col(VALUE).isNotNull())

    # Wanted ranks (0-based): floor and ceiling of p * (n - 1) for each p.
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p"))
            for name, p in quantiles.items()
        ]
    )
    targets = (
        counts.groupBy(*keys)
        .agg(
            F.sum("_n").alias("_total"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
            F.count("*").alias("_size"),
        )
        .withColumn("_w", F.explode(wanted))
        .withColumn("_pos", F.col("_w.p") * (F.col("_total") - 1))
        .withColumn("_below", F.floor("_pos"))
        .withColumn("_frac", F.col("_pos") - F.col("_below"))
        .withColumn(
            "_rank",
            F.explode(
                F.array_distinct(
                    F.array(F.col("_below"), F.least(F.col("_below") + 1, F.col("_total") - 1))
                )
            ),
        )
        .select(
            *keys,
            F.col("_w.name").alias("_name"),
            "_frac",
            "_below",
            "_rank",
            # rank still to be found inside [_lo, _hi]
            F.col("_rank").alias("_left"),
            "_lo",
            "_hi",
            "_size",
        )
    )
    targets = hand_over(targets, "quantile-targets")
    while _largest(targets) > max(rows_at_once, 2 * cells):
        targets = hand_over(_open_cells(counts, targets, keys, cells), "quantile-targets")
    found = _pick_rank(counts, targets, keys)

    picked = found.groupBy(*keys, "_name").agg(
        F.max(F.when(F.col("_rank") == F.col("_below"), F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("_rank") > F.col("_below"), F.col("_v"))).alias("_b"),
        F.max("_frac").alias("_frac"),
    )
    # From the nearer of the two values, so that the result does not leave them.
    a, b, t = F.col("_a"), F.col("_b"), F.col("_frac")
    between = F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (F.lit(1.0) - t))
    interpolated = F.when(t > 0, between).otherwise(a)
    return picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, interpolated)).alias(name) for name in quantiles]
    )


def _largest(targets: DataFrame) -> int:
    """Distinct values in the fullest interval still open."""
    return targets.agg(F.max("_size")).first()[0] or 0


def _join_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """Rename the right-hand keys and compare null-safely."""
    for key in keys:
        right = right.withColumnRenamed(key, f"_r_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"_r_{key}"])
    return right, condition


def _intervals(targets: DataFrame, keys: list[str]) -> DataFrame:
    return targets.select(*keys, "_lo", "_hi").distinct()


def _members(counts: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values lying in one of their group's open intervals. A group has
    at most two intervals per quantile and they never overlap partially."""
    intervals, same = _join_keys(counts, _intervals(targets, keys), keys)
    inside = same & F.col("_v").between(F.col("_lo"), F.col("_hi"))
    return counts.join(intervals, inside).select(*keys, "_lo", "_hi", "_v", "_n")


def _open_cells(
    counts: DataFrame, targets: DataFrame, keys: list[str], cells: int
) -> DataFrame:
    """Replace each target's interval by the cell in it that holds the rank."""
    by = [*keys, "_lo", "_hi"]
    members = _members(counts, targets, keys)
    shares = F.array(*[F.lit((i + 1) / cells) for i in range(cells - 1)])
    cuts = members.groupBy(*by).agg(F.percentile_approx("_v", shares, F.lit(100 * cells)).alias("_cuts"))
    right, same = _join_keys(members, hand_over(cuts, "quantile-cuts"), by)
    # The first cell begins at the interval's start, each further one at a cut.
    cell = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_v"))).cast("bigint")
    histogram = (
        members.join(right, same)
        .select(*members.columns, "_cuts")
        .groupBy(*by, cell.alias("_cell"))
        .agg(
            F.sum("_n").alias("_c"),
            F.min("_v").alias("_cmin"),
            F.max("_v").alias("_cmax"),
            F.count("*").alias("_csize"),
        )
    )
    # At most `cells` rows per interval, whatever the size of the group.
    running = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    histogram = histogram.withColumn("_upto", F.sum("_c").over(running))
    lookup, same = _join_keys(targets, histogram, by)
    holds = (F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_c"))
    return targets.join(lookup, same & holds).select(
        *keys,
        "_name",
        "_frac",
        "_below",
        "_rank",
        (F.col("_left") - (F.col("_upto") - F.col("_c"))).alias("_left"),
        F.col("_cmin").alias("_lo"),
        F.col("_cmax").alias("_hi"),
        F.col("_csize").alias("_size"),
    )


def _pick_rank(counts: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    by = [*keys, "_lo", "_hi"]
    running = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    members = _members(counts, targets, keys).withColumn("_upto", F.sum("_n").over(running))
    lookup, same = _join_keys(targets, members, by)
    holds = (F.col("_left") < F.col("_upto")) & (F.col("_left") >= F.col("_upto") - F.col("_n"))
    return targets.join(lookup, same & holds).select(
        *keys, "_name", "_frac", "_below", "_rank", "_v"
    )
