"""Span statistics of windows that overlap, without repeating a sale for every window.

The borders of all windows and spans cut the calendar into segments. Facts are aggregated once per
(key, segment). Segments are the leaves of a dyadic tree; a range of segments is the union of few of
its nodes, so each node that some range uses is aggregated once, and only its rows (one per
key) go to the windows and spans that use it. The rows after the scan don't depend on the number
of windows.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import sql_ratio
from shelfcast.operators.ordered import exact_medians, many_values
from shelfcast.operators.spans import _asked, _asked_medians, _widen, _with_centres, span_stats
from shelfcast.operators.windows import (
    DateIndex,
    assign_windows,
    covered,
    date_index,
    disjoint,
)


@dataclass(frozen=True)
class WindowedFacts:
    """Facts with the windows they are read through, whether these overlap or not."""

    facts: DataFrame
    windows: tuple
    dates: DateIndex

    @classmethod
    def of(cls, facts, windows):
        inside = covered(facts, windows)
        return cls(inside, tuple(windows), date_index(inside.select("data_date"), windows))

    def with_column(self, name, column):
        return WindowedFacts(self.facts.withColumn(name, column), self.windows, self.dates)

    def tagged(self):
        """The facts once per window that holds them."""
        return assign_windows(self.facts, self.windows)

    def present(self, *columns):
        """The distinct columns per window_id."""
        if disjoint(self.windows):
            return self.tagged().select("window_id", *columns).distinct()
        cuts = Segments.of(self, (), False)
        once = self.facts.selectExpr(*columns, f"{cuts.number()} AS segment").distinct()
        holders = cuts.holders(lambda window_id, first: [f"{window_id} AS window_id"])
        held = once.selectExpr(*columns, f"inline(element_at({holders}, segment))")
        return held.select("window_id", *columns).distinct()

    def stats(self, key, measures, calendar=False, order="data_date"):
        """span_stats() by (window_id, key); calendar=True takes spans as calendar days."""
        if disjoint(self.windows):
            since = self.dates.since_days if calendar else self.dates.since
            return span_stats(self.tagged(), ("window_id", key), measures, since, order)
        return _overlapping(self, key, measures, calendar, order)


class Segments:
    """The calendar cut at the borders of windows and spans; segment k starts at `starts[k]`."""

    def __init__(self, bounds):
        # Per window: first date, first dates of its spans (latest first), last date.
        self.bounds = bounds
        cuts = set()
        for lo, firsts, hi in bounds.values():
            cuts |= {lo, hi + 1, *firsts}
        self.starts = sorted(cuts)

    @classmethod
    def of(cls, windowed, spans, calendar):
        bounds = {}
        for w in windowed.windows:
            if w.window_id in windowed.dates.dates:
                lo, hi = w.feature
                firsts = [windowed.dates.first_day(w.window_id, s, calendar) for s in spans]
                bounds[w.window_id] = (lo, [max(lo, f) for f in firsts], hi)
        return cls(bounds)

    def place(self, date):
        return sum(start <= date for start in self.starts) - 1

    def number(self):
        """SQL of a date's segment: a search tree of comparisons."""

        def search(low, high):
            if low == high:
                return str(low)
            middle = (low + high + 1) // 2
            left, right = search(low, middle - 1), search(middle, high)
            return f"CASE WHEN data_date < {self.starts[middle]} THEN {left} ELSE {right} END"

        return search(0, max(len(self.starts) - 1, 0))

    def ranges(self):
        """(window_id, band, first segment, last segment); band k: the k-th shortest span is the
        shortest that holds it."""
        for window_id, (lo, firsts, hi) in self.bounds.items():
            end = self.place(hi)
            for band, first in enumerate([*firsts, lo]):
                start = self.place(first)
                if start <= end:
                    yield window_id, band, start, end
                    end = start - 1

    def cover(self):
        """{(level, node): [(window_id, band)]}: the dyadic nodes that make up each range."""
        found = {}
        for window_id, band, start, end in self.ranges():
            level = 0
            while start <= end:
                if start % 2:
                    found.setdefault((level, start), []).append((window_id, band))
                    start += 1
                if start <= end and end % 2 == 0:
                    found.setdefault((level, end), []).append((window_id, band))
                    end -= 1
                start, end, level = start // 2, end // 2, level + 1
        return found

    def holders(self, values):
        """SQL map from a segment to the windows that hold it, as structs of values(window, first)."""
        entries = []
        for k, start in enumerate(self.starts):
            held = [
                f"struct({', '.join(map(str, values(w, start)))})"
                for w, (lo, _, hi) in self.bounds.items()
                if lo <= start <= hi
            ]
            if held:
                entries.append(f"{k}, array({', '.join(held)})")
        return f"map({', '.join(entries)})"


_MERGES = {"hi": "max", "lo": "min", "first": "min", "s": "sum", "n": "sum", "rows": "sum", "": "sum"}


def _merged_piece(name):
    """SQL that merges one piece of several segments of a key."""
    column, _, kind = name.rpartition("__")
    if kind != "m2":
        return f"{_MERGES[kind]}({name}) AS {name}"
    n, s = f"{column}__n", f"{column}__s"
    away = f"CASE WHEN {n} > 0 THEN {s} - {n} * {column}__c ELSE 0 END"
    around = f"sum({name}) + sum({sql_ratio(f'pow({away}, 2)', n)})"
    return f"{around} - {sql_ratio(f'pow(sum({away}), 2)', f'sum({n})')} AS {name}"


def _overlapping(windowed, key, measures, calendar, order):
    spans, parts, wanted = _asked(measures, order)
    cuts = Segments.of(windowed, spans, calendar)
    cover = cuts.cover()
    nodes = sorted(cover)
    number = {node: k for k, node in enumerate(nodes)}
    used = {
        k: [number[(level, k >> level)] for level in range(32) if (level, k >> level) in number]
        for k in range(len(cuts.starts))
    }
    above = ", ".join(f"{k}, array({', '.join(map(str, ids))})" for k, ids in used.items() if ids)
    users = ", ".join(
        f"{number[node]}, array({', '.join(f'struct({w} AS window_id, {b} AS band)' for w, b in ranges)})"
        for node, ranges in cover.items()
    )
    pieces = [F.expr(f"{sql} AS {name}") for name, sql in parts.items()]
    once = (
        windowed.facts.withColumn("segment", F.expr(cuts.number())).groupBy(key, "segment").agg(*pieces)
    )
    centred = _with_centres(once, [key], parts)
    per_node = (
        centred.withColumn("node", F.expr(f"explode(try_element_at(map({above}), segment))"))
        .groupBy(key, "node")
        .agg(*[F.expr(_merged_piece(name)) for name in parts])
    )
    keys = ["window_id", key]
    grouped = per_node.selectExpr(
        key, *parts, f"inline(element_at(map({users}), node))"
    ).repartition(*keys)
    wide = _widen(grouped, keys, parts, wanted, spans)
    for column, medians in _asked_medians(measures).items():
        wide = wide.join(_medians(windowed, key, column, medians, calendar), keys, "left")
    return wide.select(*keys, *[name for m in measures for _, _, name in m.outputs()])


def _medians(windowed, key, column, wanted, calendar):
    """Exact medians from counts per (key, segment, value), which then go to the windows.

    The counts are moved once, to the task of their key, before the windows repeat them; only values
    that are ordered in slices are moved again.
    """
    spans = [span for span, _ in wanted if span is not None]
    cuts = Segments.of(windowed, spans, calendar)

    def weights(window_id, start):
        lo, firsts, _ = cuts.bounds[window_id]
        first_of = dict(zip(spans, firsts))
        inside = [int(start >= first_of.get(span, lo)) for span, _ in wanted]
        return [f"{window_id} AS window_id", *[f"{i} AS w{k}" for k, i in enumerate(inside)]]

    counted = (
        windowed.facts.filter(f"{column} IS NOT NULL")
        .selectExpr(key, f"cast({column} AS double) AS value", f"{cuts.number()} AS segment")
        .groupBy(key, "segment", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sliced = many_values(windowed.facts, column)
    if not sliced:
        counted = counted.repartition(key)
    counts = (
        counted.selectExpr(key, "value", "n", f"inline(element_at({cuts.holders(weights)}, segment))")
        .groupBy("window_id", key, "value")
        .agg(*[F.expr(f"sum(n * w{k}) AS {name}") for k, (_, name) in enumerate(wanted)])
    )
    names = [name for _, name in wanted]
    return exact_medians(counts, ["window_id", key], names, sliced)
