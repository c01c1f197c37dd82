"""Running counts inside groups of any size.

A window function over a group runs in one task. That is right for groups of a checked size, but
fails when one group holds a large share of the rows or when there is no group at all (a global
rank). Beyond MAX_GROUP_ROWS rows are range-partitioned by (group, order), so a large group is cut
into slices; running sums are taken inside each slice and the few groups that cross a slice
border get the totals of their earlier slices from a table with at most two rows per slice.
"""

from pyspark.sql import functions as F

from shelfcast.sources.staging import stage

# Groups up to this many rows are ordered in one task.
MAX_GROUP_ROWS = 1_000_000


def many_values(df, *columns):
    """Whether a column has so many distinct values that a group of them may be too large.

    The number of values in the table bounds the rows of any group with one row per value. The
    estimate only picks the method; both methods are exact.
    """
    found = df.agg(*[F.approx_count_distinct(c) for c in columns]).first()
    return max(found) > MAX_GROUP_ROWS


def long_groups(df, keys):
    """Whether some group has more than MAX_GROUP_ROWS rows, which bounds its distinct values, too."""
    longest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return (longest or 0) > MAX_GROUP_ROWS


def running_counts(counts, group, order, weights, sliced):
    """Add `{w}_before` (sum of w over smaller `order`) and `{w}_total` (sum over the group).

    `counts` has one row per (group, order), without NULL in the group columns. Pass sliced=False
    only for groups of a checked size.
    """
    group, order = list(group), list(order)
    return (_sliced if sliced else _whole)(counts, group, order, weights)


def _earlier(group, order):
    return (
        f"PARTITION BY {', '.join(group)} ORDER BY {', '.join(order)}"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )


def _whole(counts, group, order, weights):
    earlier, whole = _earlier(group, order), f"PARTITION BY {', '.join(group)}"
    return counts.selectExpr(
        *counts.columns,
        *[f"coalesce(sum({w}) OVER ({earlier}), 0) AS {w}_before" for w in weights],
        *[f"sum({w}) OVER ({whole}) AS {w}_total" for w in weights],
    )


def _sliced(counts, group, order, weights):
    # The slice numbers must be the same in all later steps, so the sliced rows are staged.
    placed = stage(
        counts.repartitionByRange(*group, *order).withColumn("slice", F.spark_partition_id()),
        "slices",
    )
    carried = _carried(placed, group, weights)
    local = _whole(placed, ["slice", *group], order, weights)
    joined = local.join(F.broadcast(carried), ["slice", *group], "left")
    return joined.selectExpr(
        *counts.columns,
        *[f"{w}_before + coalesce({w}_carry, 0) AS {w}_before" for w in weights],
        *[f"coalesce({w}_all, {w}_total) AS {w}_total" for w in weights],
    )


def _carried(placed, group, weights):
    """Totals of earlier slices, for groups cut by a slice border (at most two per slice)."""
    edges = placed.groupBy("slice").agg(
        F.min(F.struct(*group)).alias("first"), F.max(F.struct(*group)).alias("last")
    )
    cut = (
        edges.select("slice", F.explode(F.array("first", "last")).alias("edge"))
        .groupBy("edge")
        .agg(F.min("slice").alias("lo"), F.max("slice").alias("hi"))
        .filter("lo < hi")
        .select("edge.*")
    )
    sums = (
        placed.join(F.broadcast(cut), group, "left_semi")
        .groupBy("slice", *group)
        .agg(*[F.sum(w).alias(w) for w in weights])
    )
    earlier, whole = _earlier(group, ["slice"]), f"PARTITION BY {', '.join(group)}"
    return sums.selectExpr(
        "slice",
        *group,
        *[f"coalesce(sum({w}) OVER ({earlier}), 0) AS {w}_carry" for w in weights],
        *[f"sum({w}) OVER ({whole}) AS {w}_all" for w in weights],
    )


def middle_values(name, value="value"):
    """SQL of the lower and the higher middle value as {name}_low and {name}_high, on the rows of
    running_counts() that hold them; NULL on the others."""

    def pick(position):
        held = f"{name}_before < {position} AND {position} <= {name}_before + {name}"
        return f"CASE WHEN {held} THEN {value} END"

    return (
        f"{pick(f'floor(({name}_total + 1) / 2)')} AS {name}_low",
        f"{pick(f'floor({name}_total / 2) + 1')} AS {name}_high",
    )


def exact_medians(counts, group, names, sliced, value="value"):
    """Medians per group, one column per weight: the middle value or the mean of the two.

    `counts` has one row per (group, value); the weight `name` says how often the value occurs.
    Only the rows that hold a middle position leave the ordered step.
    """
    ranked = running_counts(counts, group, [value], names, sliced)
    low, high = zip(*[middle_values(n, value) for n in names])
    picked = ", ".join(f"{n}_{side}" for n in names for side in ("low", "high"))
    middle = ranked.selectExpr(*group, *low, *high).filter(f"coalesce({picked}) IS NOT NULL")
    return middle.groupBy(*group).agg(
        *[F.expr(f"(max({n}_low) + max({n}_high)) / 2 AS {n}") for n in names]
    )
