"""Date windows: which rows belong to which training window, and how recent they are.

Every operator works on all windows at once: a fact row is tagged with the `window_id` of each
window that holds its date, and aggregates group by (`window_id`, key).
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import days_between, shift, to_day

# Calendars have one row per day (and window); beyond this many they are not held in memory.
MAX_CALENDAR_DAYS = 1_000_000


@dataclass(frozen=True)
class WindowSpec:
    """Inclusive yyyymmdd ranges: where features come from and where labels come from."""

    window_id: int
    feature: tuple[int, int]
    label: tuple[int, int] | None = None

    def bounds(self, part):
        return self.feature if part == "feature" else self.label


def _ranges(windows, part):
    return [(w.window_id, *w.bounds(part)) for w in windows if w.bounds(part)]


def _merged(ranges):
    """Sorted ranges with touching and overlapping ones joined."""
    merged = []
    for lo, hi in sorted((lo, hi) for _, lo, hi in ranges):
        if merged and lo <= shift(merged[-1][1], 1):
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return merged


def _disjoint(ranges):
    ordered = sorted((lo, hi) for _, lo, hi in ranges)
    return all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def date_range(df, lo, hi):
    """Rows dated lo..hi, both included; reaches the scan as a pushed filter."""
    return df.filter(F.col("data_date").between(lo, hi))


def assign_windows(df, windows, part="feature"):
    """Tag rows with `window_id`, once per window that covers the date; drop the others.

    One scan serves all windows, and the covered ranges reach it as a pushed filter. Disjoint
    windows need a CASE only; overlapping ones repeat the row by a generator over a literal array,
    not by a join.
    """
    ranges = _ranges(windows, part)
    covered = [f"data_date BETWEEN {lo} AND {hi}" for lo, hi in _merged(ranges)]
    kept = df.filter(" OR ".join(covered))
    tags = [f"WHEN data_date BETWEEN {lo} AND {hi} THEN {wid}" for wid, lo, hi in ranges]
    if _disjoint(ranges):
        return kept.selectExpr("*", f"CASE {' '.join(tags)} END AS window_id")
    cases = ", ".join(f"CASE {tag} END" for tag in tags)
    return kept.selectExpr("*", f"explode(array_compact(array({cases}))) AS window_id")


def disjoint(windows, part="feature"):
    return _disjoint(_ranges(windows, part))


def covered(df, windows, part="feature"):
    """The rows of any window, once each; the ranges reach the scan as a pushed filter."""
    ranges = _merged(_ranges(windows, part))
    return df.filter(" OR ".join(f"data_date BETWEEN {lo} AND {hi}" for lo, hi in ranges))


def _day_count(windows, part):
    return sum(days_between(lo, hi) for _, lo, hi in _ranges(windows, part))


def small_calendar(df, windows, part="feature"):
    """Broadcast hint for a table with one row per date, if the windows cover few days."""
    return F.broadcast(df) if _day_count(windows, part) <= MAX_CALENDAR_DAYS else df


class DateIndex:
    """The distinct dates present in each window, oldest first.

    Spans and weeks are counted in dates that occur, so they need this list. It holds at most one
    entry per calendar day and window, whatever the size of the facts; the conditions made from
    it are literals, so no operator joins or scans the facts again for them.
    """

    def __init__(self, dates):
        self.dates = {wid: sorted(days) for wid, days in dates.items()}

    def _lookup(self, value):
        """SQL of a literal map from window_id to value(dates), looked up for the row.

        A map keeps the generated code small; nested CASE branches would outgrow what the JVM
        compiles.
        """
        entries = ", ".join(f"{wid}, {value(days)}" for wid, days in self.dates.items())
        return f"try_element_at(map({entries}), window_id)" if entries else "NULL"

    def since(self, span):
        """SQL of the first date of the last `span` distinct dates (of all, where fewer)."""
        return self._lookup(lambda days: days[-min(span, len(days))])

    def since_days(self, days):
        """SQL of the date `days` calendar days before the last date; spans days + 1 days."""
        return self._lookup(lambda d: shift(d[-1], -days))

    def first_day(self, window_id, span, calendar=False):
        """First date of a span of a window: of distinct dates, or of calendar days before the last."""
        days = self.dates[window_id]
        return shift(days[-1], -span) if calendar else days[-min(span, len(days))]

    def week(self, k, size=7):
        """SQL condition: the k-th block of `size` distinct dates, counted from the first."""
        blocks = {wid: days[k * size : (k + 1) * size] for wid, days in self.dates.items()}
        found = DateIndex({wid: block for wid, block in blocks.items() if block})
        first, last = found._lookup(lambda d: d[0]), found._lookup(lambda d: d[-1])
        return f"data_date BETWEEN {first} AND {last}"


def date_positions(tagged):
    """The date index as a table: position from the first date (0) and from the last (1)."""
    dates = Window.partitionBy("window_id")
    present = tagged.select("window_id", "data_date").distinct()
    return present.select(
        "window_id",
        "data_date",
        (F.row_number().over(dates.orderBy("data_date")) - 1).alias("day_pos"),
        F.row_number().over(dates.orderBy(F.desc("data_date"))).alias("recency"),
        F.datediff(to_day(F.max("data_date").over(dates)), to_day("data_date")).alias("age_days"),
    )


def date_index(tagged, windows, part="feature"):
    """Read the distinct dates of all windows: a scan of the date column alone.

    `tagged` are rows of assign_windows(), or of covered(), without window_id.
    """
    if _day_count(windows, part) > MAX_CALENDAR_DAYS:
        raise ValueError("the windows cover too many days for a date index")
    if "window_id" not in tagged.columns:
        days = sorted(r[0] for r in tagged.select("data_date").distinct().collect())
        inside = {w: [d for d in days if lo <= d <= hi] for w, lo, hi in _ranges(windows, part)}
        return DateIndex({w: found for w, found in inside.items() if found})
    found = tagged.select("window_id", "data_date").distinct().toPandas()
    return DateIndex(
        {int(w): [int(d) for d in days] for w, days in found.groupby("window_id")["data_date"]}
    )
