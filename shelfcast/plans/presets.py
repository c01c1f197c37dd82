"""Windows and parameters of the ready-made forecasts. All dates are fixed values, inclusive."""

from dataclasses import dataclass, field

from shelfcast.operators.windows import WindowSpec

TEST_WINDOW = 99


def numbered_windows(pairs, test):
    specs = [WindowSpec(i, feature, label) for i, (feature, label) in enumerate(pairs, 1)]
    return tuple(specs), WindowSpec(TEST_WINDOW, test)


# Two windows of 27 days.
SHORT_PAIRS = (
    ((20170301, 20170327), (20170512, 20170615)),
    ((20170920, 20171016), (20171201, 20180104)),
)
SHORT_TEST = (20180218, 20180316)

# Windows of 60 days.
LONG_PAIRS = (
    ((20170613, 20170811), (20170926, 20171030)),
    ((20170816, 20171014), (20171129, 20180102)),
    ((20170819, 20171017), (20171202, 20180105)),
    ((20170822, 20171020), (20171205, 20180108)),
)
LONG_TEST = (20180116, 20180316)

SALES_PAIRS = (
    ((20170612, 20170810), (20170925, 20171029)),
    ((20170614, 20170812), (20170927, 20171031)),
    ((20170815, 20171013), (20171128, 20180101)),
    ((20170818, 20171016), (20171201, 20180104)),
    ((20170820, 20171018), (20171203, 20180106)),
)

# Windows of 50 days; the first label range has 36 days.
CONTEXT_PAIRS = (
    ((20170619, 20170807), (20170921, 20171026)),
    ((20170626, 20170814), (20170928, 20171102)),
    ((20170703, 20170821), (20171005, 20171109)),
    ((20170831, 20171019), (20171203, 20180107)),
    ((20170907, 20171026), (20171210, 20180114)),
)
CONTEXT_TEST = (20180126, 20180316)

# Day grain: 24 days of history, 35 label days.
DAY_PAIRS = (
    ((20170301, 20170324), (20170509, 20170612)),
    ((20170613, 20170706), (20170821, 20170924)),
    ((20170925, 20171018), (20171123, 20171227)),
)
DAY_TEST = ((20180221, 20180316), (20180501, 20180604))

RULE_RANGE = (20180214, 20180316)
# Forecast totals of the five weeks and the factor applied to each.
RULE_TOTALS = (290000.0, 400000.0, 550000.0, 600000.0, 240000.0)
RULE_FACTORS = (1.0, 1.02, 1.02, 1.12, 1.04)

FORECAST_START = 20180501

# Recency spans in distinct dates (granularities in calendar days).
RANKED_SPANS = (3, 5, 7, 14, 21, 27)
SALES_SPANS = (2, 3, 5, 7, 9, 12, 14)
SHORT_SALE_SPANS = (1, 2, 3, 5, 7, 9, 12)
SHORT_DAILY_SPANS = (1, 3, 7, 9, 12)
SHORT_DAILY_SPANS_ALT = (3, 5, 7, 9, 12)
CONTEXT_SPANS = (3, 5, 7, 14, 21, 35)
GRANULARITIES = (24, 21, 14, 7, 5, 3, 1)


@dataclass(frozen=True)
class Boosting:
    """Parameters of gradient-boosted trees as published for each model.

    rounds     trees a fit grows;  rate  share of each leaf value that is added;
    depth      of a tree, at most;  leaves  of a tree, at most (None: as the depth allows);
    min_child  rows of a leaf, at least;  gamma  half of the gain that a split must exceed;
    l1, l2     shrinkage of leaf values;
    row_share, column_share  what a tree learns from.
    """

    rate: float
    depth: int
    rounds: int
    leaves: int | None = None
    min_child: int = 1
    l1: float = 0.0
    l2: float = 0.0
    gamma: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0


@dataclass(frozen=True)
class Preset:
    feature_set: str
    model: str
    pairs: tuple = ()
    test: tuple = ()
    boosting: Boosting | None = None
    clamp: str = "zero_null"
    # How price text is read ("const" takes text with a separator for one fixed value), and whether
    # the weeks of the forecast are swapped end to end.
    price_mode: str = "strip"
    reverse: bool = False
    options: dict = field(default_factory=dict)

    def windows(self):
        return numbered_windows(self.pairs, self.test)


PRESETS = {
    "share_of_total": Preset("none", "rule"),
    "linear_slides": Preset("linear", "ols", SHORT_PAIRS[:1], SHORT_TEST),
    "linear_short_slide": Preset("short_slide", "ols", LONG_PAIRS, LONG_TEST),
    "boosted_slide_rank": Preset(
        "slide_rank",
        "boosted",
        SHORT_PAIRS,
        SHORT_TEST,
        Boosting(0.06, 6, 2000, leaves=31, min_child=25, l1=0.1, l2=0.2),
    ),
    "boosted_sales_only": Preset(
        "sales_only",
        "boosted",
        SALES_PAIRS,
        LONG_TEST,
        Boosting(0.1, 7, 2500, leaves=127, min_child=25, l1=0.5, l2=0.2),
    ),
    "boosted_short_slide": Preset(
        "short_slide",
        "boosted",
        LONG_PAIRS,
        LONG_TEST,
        Boosting(0.06, 7, 2000, leaves=63, min_child=25, l1=0.1, l2=0.2),
    ),
    "boosted_goods_context": Preset(
        "goods_context",
        "boosted",
        CONTEXT_PAIRS,
        CONTEXT_TEST,
        Boosting(0.06, 6, 2000, leaves=31, min_child=500, l1=0.5, l2=0.2),
    ),
    "boosted_granularity": Preset(
        "granularity",
        "boosted",
        SHORT_PAIRS,
        SHORT_TEST,
        Boosting(0.03, 25, 1000, leaves=31, min_child=25, l1=0.1, l2=0.2),
        clamp="keep_null",
    ),
    "boosted_granularity_sampled": Preset(
        "granularity",
        "boosted",
        SHORT_PAIRS,
        SHORT_TEST,
        Boosting(0.03, 5, 1500, min_child=18, row_share=0.8, column_share=0.8),
        clamp="keep_null",
    ),
    "boosted_short_slide_two_windows": Preset(
        "short_slide",
        "boosted",
        SHORT_PAIRS,
        SHORT_TEST,
        Boosting(0.03, 6, 1000, min_child=18),
        options={"daily_spans": SHORT_DAILY_SPANS_ALT},
    ),
    "boosted_short_slide_sampled": Preset(
        "short_slide",
        "boosted",
        LONG_PAIRS,
        LONG_TEST,
        Boosting(
            0.02, 6, 1000, min_child=18, l2=5.0, gamma=0.1, row_share=0.8, column_share=0.7
        ),
    ),
    "linear_day_level": Preset("day_level", "day_ols", DAY_PAIRS, DAY_TEST, clamp="round", price_mode="const"),
    "boosted_day_level": Preset(
        "day_level",
        "day_boosted",
        DAY_PAIRS,
        DAY_TEST,
        Boosting(0.02, 5, 60, row_share=0.8, column_share=0.8),
        clamp="none",
        price_mode="const",
    ),
    "boosted_day_level_selected": Preset(
        "day_level",
        "day_selected",
        DAY_PAIRS,
        DAY_TEST,
        Boosting(0.01, 5, 1500, leaves=31, row_share=0.8, column_share=0.8),
        clamp="none",
        price_mode="const",
    ),
    # Five weekly targets at once, a value of each in every leaf, with default trees. The targets are weekly, so the
    # inputs are the weekly ranked slides.
    "boosted_multi_output": Preset(
        "slide_rank",
        "multi_output",
        SHORT_PAIRS,
        SHORT_TEST,
        Boosting(0.1, 3, 100),
        clamp="keep_null",
    ),
}
