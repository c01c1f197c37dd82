"""Aggregates over many nested recency spans of a window in one pass.

Spans are nested (the last 3 days lie in the last 7), so a row is counted once, in its band: the
shortest span that holds it. Level one aggregates per (keys, band), with partial aggregation
before its shuffle, so a key that owns a large share of the rows shrinks to a few rows per task.
Level two has at most `len(spans) + 1` narrow rows per key; they are shuffled once and widened
to the many (measure, statistic, span) columns only after that shuffle.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from shelfcast.functions.numeric import sql_ratio
from shelfcast.operators.ordered import exact_medians, long_groups, many_values


@dataclass(frozen=True)
class Measure:
    """What to compute of one column: `stats` per span, `total` over the whole window."""

    column: str
    stats: tuple[str, ...] = ()
    spans: tuple[int, ...] = ()
    total: tuple[str, ...] = ()
    span_name: str = "{column}_{stat}_slide_{span}"
    total_name: str = "{column}_{stat}"

    def outputs(self):
        """(statistic, span or None, output name) of every column asked for."""
        named = [
            (stat, span, self.span_name.format(column=self.column, stat=stat, span=span))
            for span in self.spans
            for stat in self.stats
        ]
        return named + [
            (stat, None, self.total_name.format(column=self.column, stat=stat))
            for stat in self.total
        ]


def span_stats(df, keys, measures, since=None, order="data_date"):
    """Wide statistics per key; a span without rows gives NULL.

    `since` maps a span to SQL of its first date, e.g. DateIndex.since.

    Statistics: max, min, mean, sum, count (non-null values), rows, var, std, first (value at the
    smallest `order`), median (exact).
    """
    keys = list(keys)
    wide = _combine(df, keys, measures, since, order)
    for column, medians in _asked_medians(measures).items():
        wide = wide.join(_medians(df, keys, column, medians, since), keys, "left")
    names = [name for m in measures for _, _, name in m.outputs()]
    return wide.select(*keys, *names)


def _asked(measures, order):
    """Spans, level-one pieces and (column, statistic, span, name) of all measures."""
    spans = sorted({s for m in measures for s in m.spans})
    parts = {"rows__": "count(1)"}
    for m in measures:
        for stat, _, _ in m.outputs():
            parts.update(_parts(m.column, stat, order))
    wanted = [
        (m.column, stat, span, name)
        for m in measures
        for stat, span, name in m.outputs()
        if stat != "median"
    ]
    return spans, parts, wanted


def _asked_medians(measures):
    """Per column the (span, name) of all its medians; one ordered step serves a column."""
    found = {}
    for m in measures:
        medians = [(span, name) for stat, span, name in m.outputs() if stat == "median"]
        if medians:
            found.setdefault(m.column, []).extend(medians)
    return found


def _combine(df, keys, measures, since, order):
    spans, parts, wanted = _asked(measures, order)
    pieces = [F.expr(f"{sql} AS {name}") for name, sql in parts.items()]
    if not spans:
        grouped = df.groupBy(*keys).agg(*pieces)
        return grouped.selectExpr(
            *keys, *[f"{_single(column, stat)} AS {name}" for column, stat, _, name in wanted]
        )
    # Longer spans start earlier, so the number of later starts is the shortest span that fits.
    later = " + ".join(f"cast(data_date < {since(span)} AS int)" for span in spans)
    banded = df.selectExpr("*", f"{later} AS band")
    grouped = banded.groupBy(*keys, "band").agg(*pieces).repartition(*keys)
    return _widen(grouped, keys, parts, wanted, spans)


def _widen(grouped, keys, parts, wanted, spans):
    """Level two: the pieces per (keys, band) become one wide row per key."""
    finals = []
    for column, stat, span, name in wanted:
        inside = None if span is None else f"band <= {spans.index(span)}"
        finals.append(F.expr(f"{_merge(column, stat, inside)} AS {name}"))
    return _with_centres(grouped, keys, parts).groupBy(*keys).agg(*finals)


def _parts(column, stat, order):
    """Mergeable pieces a statistic needs from level one."""
    n = {f"{column}__n": f"count({column})"}
    s = {f"{column}__s": f"cast(coalesce(sum({column}), 0) AS double)"}
    squares = {f"{column}__m2": f"var_pop({column}) * count({column})"}
    return {
        "max": {f"{column}__hi": f"max({column})"},
        "min": {f"{column}__lo": f"min({column})"},
        "sum": s,
        "count": n,
        "mean": {**n, **s},
        "var": {**n, **s, **squares},
        "std": {**n, **s, **squares},
        "first": {f"{column}__first": f"min(struct({order}, {column} AS v))"},
        "rows": {},
        "median": {},
    }[stat]


def _with_centres(grouped, keys, parts):
    """Add each key's overall mean, so that squared deviations merge without cancellation."""
    columns = [name[: -len("__m2")] for name in parts if name.endswith("__m2")]
    if not columns:
        return grouped
    key = f"OVER (PARTITION BY {', '.join(keys)})"
    return grouped.selectExpr(
        "*", *[f"{sql_ratio(f'sum({c}__s) {key}', f'sum({c}__n) {key}')} AS {c}__c" for c in columns]
    )


def _merge(column, stat, inside):
    """Level-two aggregate over the bands of one key that satisfy `inside`."""

    def over(function, sql):
        return f"{function}({sql if inside is None else f'CASE WHEN {inside} THEN {sql} END'})"

    n, s = f"{column}__n", f"{column}__s"
    if stat == "mean":
        return sql_ratio(over("sum", s), over("sum", n))
    if stat == "first":
        return f"{over('min', f'{column}__first')}.v"
    if stat in ("var", "std"):
        shift = f"CASE WHEN {n} > 0 THEN {s} - {n} * {column}__c ELSE 0 END"
        within = over("sum", f"{column}__m2")
        between = over("sum", sql_ratio(f"pow({shift}, 2)", n))
        centre = sql_ratio(f"pow({over('sum', shift)}, 2)", over("sum", n))
        return _spread(f"{within} + {between} - {centre}", over("sum", n), stat)
    function, piece = {
        "max": ("max", f"{column}__hi"),
        "min": ("min", f"{column}__lo"),
        "sum": ("sum", s),
        "count": ("sum", n),
        "rows": ("sum", "rows__"),
    }[stat]
    return over(function, piece)


def _single(column, stat):
    """Final expression when level one already holds the whole window."""
    n, s = f"{column}__n", f"{column}__s"
    if stat in ("var", "std"):
        return _spread(f"{column}__m2", n, stat)
    return {
        "max": f"{column}__hi",
        "min": f"{column}__lo",
        "sum": s,
        "count": n,
        "rows": "rows__",
        "mean": sql_ratio(s, n),
        "first": f"{column}__first.v",
    }[stat]


def _spread(squares, n, stat):
    var = f"CASE WHEN {n} > 1 THEN {sql_ratio(f'greatest({squares}, 0)', f'{n} - 1')} END"
    return f"sqrt({var})" if stat == "std" else var


def _medians(df, keys, column, wanted, since):
    """Exact medians of one column for several spans, from counts per distinct value.

    Rows before the longest span belong to none of the medians, so they are neither counted nor ordered.
    """
    spans = [span for span, _ in wanted]
    if None not in spans:
        df = df.filter(f"data_date >= {since(max(spans))}")
    weights = [
        F.expr(f"sum({'1' if span is None else f'cast(data_date >= {since(span)} AS int)'}) AS {name}")
        for span, name in wanted
    ]
    counts = (
        df.filter(f"{column} IS NOT NULL")
        .groupBy(*keys, F.col(column).cast("double").alias("value"))
        .agg(*weights)
    )
    sliced = many_values(df, column) and long_groups(df, keys)
    return exact_medians(counts, keys, [name for _, name in wanted], sliced)
