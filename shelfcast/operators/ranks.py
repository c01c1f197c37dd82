"""Ranks of feature columns over all variants of a window, or inside one goods.

All rank columns of a feature table are computed together: values are unpivoted to
(series, value). Small tables are ordered directly, one series per window and task. Large ones are
counted per distinct value before the shuffle, ordered by running_counts and looked up by value,
so ties and hot values cost one row each in the ordered step. Series over the whole window with few
distinct values are looked up where their rows lie, from a table of bounded size, so these rows
aren't shuffled at all. Of the others, the few values that many rows share are looked up by a
broadcast (their number is bounded), the rest by hash.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.operators import ordered
from shelfcast.operators.ordered import running_counts
from shelfcast.sources.staging import stage


# Values that occur in more than one of so many rows are hot; there are fewer of them than this.
HOT_VALUES = 10_000
# Tables of up to so many times HOT_VALUES rows are held by the tasks that look ranks up in them.
HELD_SHARE = 50
# So many rank columns are picked by one conditional aggregate each.
FEW_RANKS = 12


@dataclass(frozen=True)
class RankSpec:
    """Rank `source` into `target`.

    method    "min" or "average";  within  a grouping column, or None for the whole window;
    fill      value that stands in for missing ones before ranking (None leaves them unranked).
    """

    source: str
    target: str
    method: str = "average"
    ascending: bool = True
    within: str | None = None
    fill: float | None = None

    @property
    def series(self):
        return (self.source, self.within, self.fill)


def _position(spec, before, n, total):
    """SQL of the rank, from the number of rows before, at and in the whole ordering."""
    first = before if spec.ascending else f"{total} - {before} - {n}"
    if spec.method == "average":
        return f"{first} + ({n} + 1) / 2"
    return f"cast({first} + 1 AS double)"


def _by_series(specs, number, columns, suffix=""):
    """One aggregate per spec that picks the rank from the row of its series."""
    return [
        F.expr(
            f"max(CASE WHEN series = {number[s.series]} THEN {_position(s, *columns)} END)"
            f" AS {s.target}{suffix}"
        )
        for s in specs
    ]


def rank_columns(features, specs, key="sku_id", by_value=None):
    """Add the rank columns of `specs`; `features` has one row per (window_id, key).

    The features are read several times, so they are staged first. Both methods give the same
    ranks; by_value picks one, by default the number of rows does.
    """
    features = stage(features, "features")
    series = sorted({s.series for s in specs}, key=str)
    number = {s: i for i, s in enumerate(series)}
    rows = features.count()
    if rows > ordered.MAX_GROUP_ROWS if by_value is None else by_value:
        return _rank_by_value(features, specs, series, number, key, rows)
    return _rank_rows(features, specs, series, number, key)


def _rank_rows(features, specs, series, number, key):
    """Order the rows of each series directly, where no series is too large for a task."""
    long = _unpivot(features, series, key, fill_global=True)
    # All three counts share one partitioning and order, so one sort serves them.
    order = "PARTITION BY window_id, series, scope ORDER BY value"
    placed = long.selectExpr(
        "window_id",
        key,
        "series",
        f"rank() OVER ({order}) - 1 AS n_before",
        f"count(1) OVER ({order} RANGE BETWEEN CURRENT ROW AND CURRENT ROW) AS n",
        f"count(1) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        " AS n_total",
    )
    ranks = _pivot(placed, specs, number, key)
    return features.join(ranks, ["window_id", key], "left")


def _rank_by_value(features, specs, series, number, key, rows):
    """Order the distinct values of each series and look the ranks up by value."""
    long = _unpivot(features, series, key, fill_global=False)
    # A global series with a fill value counts its missing rows instead of shuffling them.
    filled = [s for s in series if s[1] is None and s[2] is not None]
    counted = long.select("window_id", "series", "scope", "value", F.lit(1).alias("n"))
    if filled:
        gaps = stage(_gaps(features, filled, number), "gaps")
        counted = counted.unionByName(
            gaps.filter("gaps > 0").select(
                "window_id",
                "series",
                F.lit(0).cast("bigint").alias("scope"),
                F.col("fill").alias("value"),
                F.col("gaps").alias("n"),
            )
        )
    group = ["window_id", "series", "scope"]
    counts = counted.groupBy(*group, "value").agg(F.sum("n").alias("n"))
    placed = stage(running_counts(counts, group, ["value"], ["n"], sliced=True), "places")
    held = _held_series(placed, series)
    result = features
    left = [s for s in specs if number[s.series] not in held]
    if left:
        some = [s for s in series if number[s] not in held]
        long = _unpivot(features, some, key, fill_global=False, number=number)
        joined = placed.where(F.col("series").isin([number[s] for s in some]))
        found = _look_up(long, joined, [*group, "value"], rows * len(some) // HOT_VALUES)
        result = result.join(_pivot(found, left, number, key), ["window_id", key], "left")
    # Rows move for the join above only, before they get the many ranks of the held series.
    result = _rank_held(result, placed, specs, held, number, key)
    result = result.select(*features.columns, *[s.target for s in specs])
    return _rank_gaps(result, gaps, specs, number) if filled else result


def _held_series(placed, series):
    """Numbers of the series over whole windows, shortest first, that tasks can hold together."""
    whole = [i for i, (_, within, _) in enumerate(series) if within is None]
    sizes = placed.where(F.col("series").isin(whole)).groupBy("series").count()
    held, room = set(), HELD_SHARE * HOT_VALUES
    for row in sizes.orderBy("count", "series").collect():  # one row per series
        room -= row["count"]
        if room >= 0:
            held.add(row["series"])
    return held


def _rank_held(features, placed, specs, held, number, key):
    """The features with the ranks of the held series, by a search in each one's sorted values.

    A table of bounded size goes to the tasks; the rows of the features stay where they are. As in a
    join by key, a row without key or window gets no rank.
    """
    specs = [s for s in specs if number[s.series] in held]
    if not specs:
        return features
    places = placed.where(F.col("series").isin(sorted(held)) & F.col("window_id").isNotNull())
    table = places.toArrow()
    table = table.select(["window_id", "series", "value", "n_before", "n", "n_total"])
    window, which, *columns = (c.to_numpy() for c in table.columns)
    order = np.lexsort((columns[0], which, window))
    window, which, *columns = (c[order] for c in (window, which, *columns))
    starts = np.flatnonzero(np.r_[True, (np.diff(window) != 0) | (np.diff(which) != 0)])[: len(window)]
    places = {
        (int(window[a]), int(which[a])): [c[a:b] for c in columns]
        for a, b in zip(starts, [*starts[1:], len(window)])
    }
    shared = features.sparkSession.sparkContext.broadcast(places)
    wanted = [(s.source, number[s.series], s.method, s.ascending, s.target) for s in specs]

    def run(batches):
        for batch in batches:
            known = batch.column(key).is_valid().to_numpy(zero_copy_only=False)
            windows = batch.column("window_id")
            known &= windows.is_valid().to_numpy(zero_copy_only=False)
            windows = windows.to_numpy(zero_copy_only=False)
            present = [(w, known & (windows == w)) for w in np.unique(windows[known])]
            added, found = [], {}
            for source, which, method, ascending, _ in wanted:
                if which not in found:
                    column = batch.column(source)
                    valid = column.is_valid().to_numpy(zero_copy_only=False)
                    values = column.to_numpy(zero_copy_only=False).astype(np.float64)
                    counts, known_value = np.zeros((3, len(values))), np.zeros(len(values), bool)
                    for w, rows in present:
                        if (int(w), which) in shared.value:
                            ordered, *numbers = shared.value[int(w), which]
                            rows = np.flatnonzero(rows & valid)
                            # NaN is the largest value, here as in Spark.
                            at = np.searchsorted(ordered, values[rows])
                            counts[:, rows] = [c[at] for c in numbers]
                            known_value[rows] = True
                    found[which] = counts, known_value
                (before, n, total), known_value = found[which]
                first = before if ascending else total - before - n
                rank = first + (n + 1) / 2 if method == "average" else first + 1
                added.append(pa.array(rank, pa.float64(), mask=~known_value))
            names = [*batch.schema.names, *[target for *_, target in wanted]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema]
    return features.mapInArrow(run, ", ".join([*fields, *[f"`{s.target}` double" for s in specs]]))


def _look_up(long, placed, keys, often):
    """The rows of `long` with the counts of their value, hot values by broadcast.

    A hot value stands for more than `often` rows, which bounds the number of hot values.
    """
    counts = ["n_before", "n", "n_total"]
    hot = placed.where(F.col("n") > often).select(*keys, F.struct(*counts).alias("hot"))
    marked = long.join(F.broadcast(hot), keys, "left")
    warm = marked.where("hot IS NOT NULL").select(*long.columns, "hot.*")
    rest = marked.where("hot IS NULL").drop("hot").join(placed.where(F.col("n") <= often), keys)
    return warm.select(*long.columns, *counts).unionByName(rest.select(*long.columns, *counts))


def _pivot(placed, specs, number, key):
    """One row per (window_id, key).

    The narrow rows are shuffled, not the widened ones, and gathered into a map with one entry
    per series, which is cheaper than one conditional aggregate per rank column if there are many.
    """
    if len(specs) <= FEW_RANKS:
        # Buffers of fixed width are hashed; lists are sorted by key. Repeated keys are refused, as by a map.
        ranks = _by_series(specs, number, ("n_before", "n", "n_total"))
        seen = {s.target: f"seen{number[s.series]}" for s in specs}
        counts = [F.expr(f"count_if(series = {name[4:]}) AS {name}") for name in sorted(set(seen.values()))]
        found = placed.repartition("window_id", key).groupBy("window_id", key).agg(*ranks, *counts)
        refused = "raise_error('several rows of one window and key have ranks')"
        return found.selectExpr(
            "window_id", key, *[f"if({name} > 1, {refused}, {target}) AS {target}" for target, name in seen.items()]
        )
    counts = "struct(n_before, n, n_total)"
    gathered = (
        placed.repartition("window_id", key)
        .groupBy("window_id", key)
        .agg(F.expr(f"map_from_entries(collect_list(struct(series, {counts}))) AS found"))
    )
    ranks = []
    for s in specs:
        entry = f"try_element_at(found, {number[s.series]})"
        columns = [f"{entry}.{name}" for name in ("n_before", "n", "n_total")]
        ranks.append(f"{_position(s, *columns)} AS {s.target}")
    return gathered.selectExpr("window_id", key, *ranks)


def _unpivot(features, series, key, fill_global, number=None):
    """(window_id, key, series, scope, value) for every value that gets its own rank."""
    entries = []
    for i, one in enumerate(series):
        source, within, fill = one
        i = number[one] if number else i
        value = f"cast({source} AS double)"
        if fill is not None and (fill_global or within is not None):
            value = f"coalesce({value}, {fill}D)"
        entries.append(f"struct({i} AS series, cast({within or 0} AS bigint) AS scope, {value} AS value)")
    return features.selectExpr("window_id", key, f"inline(array({', '.join(entries)}))").filter(
        "value IS NOT NULL AND scope IS NOT NULL"
    )


def _gaps(features, filled, number):
    """Per window and filled series: missing rows and where the fill value stands."""
    sums = [
        f"struct({number[(v, None, fill)]} AS series, {fill}D AS fill,"
        f" count_if({v} IS NULL) AS gaps, count_if({v} < {fill}D) AS below,"
        f" count_if({v} IS NULL OR {v} = {fill}D) AS at, count(1) AS rows)"
        for v, _, fill in filled
    ]
    stats = F.expr(f"array({', '.join(sums)}) AS stats")
    return features.groupBy("window_id").agg(stats).selectExpr("window_id", "inline(stats)")


def _rank_gaps(result, gaps, specs, number):
    """Give missing rows the rank of the fill value, from one row per window."""
    chosen = [s for s in specs if s.within is None and s.fill is not None]
    wide = gaps.groupBy("window_id").agg(
        *_by_series(chosen, number, ("below", "at", "rows"), "__gap")
    )
    targets = {s.target for s in chosen}
    return result.join(F.broadcast(wide), "window_id", "left").selectExpr(
        *[f"coalesce({c}, {c}__gap) AS {c}" if c in targets else c for c in result.columns]
    )


def fuse_ranks(scores, group, key, first, second):
    """Reciprocal-rank fusion of two scores inside each group.

    Average ranks r1, r2 (ascending) give 0.5/r1 + 0.5/r2; the result is the position by
    descending fused score, ties broken by `key`. A row without one of the scores has no fused score
    and no position, and takes no place from others.
    """
    scores = stage(scores.select(group, key, first, second), "scores")
    large = scores.count() > ordered.MAX_GROUP_ROWS
    ranked = rank_columns(
        scores.withColumn("window_id", F.lit(0)),
        [
            RankSpec(first, "rank1", within=group),
            RankSpec(second, "rank2", within=group),
        ],
        key=key,
    )
    fused = ranked.select(
        group,
        key,
        (F.lit(0.5) / F.col("rank1") + F.lit(0.5) / F.col("rank2")).alias("fused"),
    )
    lined = fused.filter(F.col(group).isNotNull() & F.col("fused").isNotNull()).select(
        "*", (-F.col("fused")).alias("falling"), F.lit(1).alias("n")
    )
    placed = running_counts(lined, [group], ["falling", key], ["n"], sliced=large)
    ranks = placed.select(group, key, (F.col("n_before") + 1).alias("fused_rank"))
    return fused.filter(F.col(group).isNotNull()).join(ranks, [group, key], "left")
