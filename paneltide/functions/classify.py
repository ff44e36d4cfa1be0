"""Classification ladders as Column expressions.

Every ladder is a chain of ``F.when`` built from a parameter table, so each class rule is a
single codegen'd expression and never a UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# ---------------------------------------------------------------------------------------
# Fixed values that must equal the published classes (labels, breaks, codes).
# ---------------------------------------------------------------------------------------

# Period-over-period change classes: cuts -Inf, -0.5, -0.1, 0, 0.1, 1, Inf, right-closed,
# lowest interval closed on the left as well.
CHANGE_CUTS = [-0.5, -0.1, 0.0, 0.1, 1.0]
CHANGE_LABELS = [
    "decrease of more than 50%",
    "decrease of 11-50%",
    "decrease of 1-10%",
    "increase of 0-9%",
    "increase of 10-99%",
    "increase of 100%+",
]
CHANGE_CODES = ["val1", "val2", "val3", "val4", "val5", "val6"]

# Fixed-break bins per indicator family: (indicators, breaks, ticks).  Breaks start at 0 and
# the last bin is open (to infinity); ticks are the legend values per class 1..6.
BREAK_FAMILIES = {
    "count_vaccinated": (
        ["total_vaccinations", "people_vaccinated", "people_fully_vaccinated", "total_boosters"],
        [0, 1e3, 1e4, 1e5, 1e6, 1e7],
        [1e3, 1e4, 1e5, 1e6, 1e7, 5e8],
    ),
    "rate_vaccinated": (
        ["people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
         "total_boosters_per_hundred", "people_with_booster_per_hundred"],
        [0, 5, 10, 20, 50, 70],
        [5, 10, 20, 50, 70, 100],
    ),
    "rate_doses": (
        ["total_vaccinations_per_hundred", "daily_people_vaccinated_per_hundred"],
        [0, 5, 10, 20, 50, 70],
        [5, 10, 20, 50, 70, 200],
    ),
    "count_daily": (
        ["daily_vaccinations", "daily_people_vaccinated"],
        [0, 10, 1e2, 1e3, 1e4, 1e5],
        [10, 1e2, 1e3, 1e4, 1e5, 5e6],
    ),
    "rate_daily": (
        ["daily_vaccinations_per_million"],
        [0, 1, 10, 50, 100, 1e3],
        [1, 10, 50, 100, 1e3, 10e4],
    ),
}

# Coverage bins, left-closed [a, b): (upper bound, label); order code = position + 1.
COVERAGE_BINS = [
    (3, "<3"),
    (10, "3 - <10"),
    (20, "10 - <20"),
    (30, "20 - <30"),
    (40, "30 - <40"),
    (60, "40 - <60"),
    (70, "60 - <70"),
]
COVERAGE_TOP = "70+"
COVERAGE_NO_DATA = "No data"

# Incidence classes per 100k (lower bound, label); below the first bound is "Low".
INCIDENCE_CLASSES = [
    (10, "Moderate Incidence"),
    (50, "Substantial Incidence"),
    (100, "High Incidence"),
]
INCIDENCE_LOW = "Low Incidence"

# Direction of change on the capped percent change: (label); thresholds -10 / 0 / 10.
DIRECTION_NA = "N/A"
DIRECTION_LABELS = ["Decreasing", "Moderate Decreasing", "Moderate Increasing", "Increasing"]

# Simplified classes and the combined trajectory.
INCIDENCE_SIMPLE = {"Low/Moderate": ["Low Incidence", "Moderate Incidence"],
                    "High/Substantial": ["Substantial Incidence", "High Incidence"]}
DIRECTION_SIMPLE = {"Decreasing": ["Decreasing", "Moderate Decreasing"],
                    "Increasing": ["Increasing", "Moderate Increasing"]}
TRAJECTORY_LABELS = {
    ("Low/Moderate", "Decreasing"): "Low/Moderate Incidence, Decreasing",
    ("Low/Moderate", "Increasing"): "Low/Moderate Incidence, Increasing",
    ("High/Substantial", "Decreasing"): "Substantial/High Incidence, Decreasing",
    ("High/Substantial", "Increasing"): "Substantial/High Incidence, Increasing",
}

# Sparse-count text: "<10 <Indicator> in past <period>".
SPARSE_PREFIX, SPARSE_MIDDLE = "<10 ", " in past "

# Quantile-class texts for rows without a class.
QCLASS_ABSENT, QCLASS_NOT_ESTIMATED = "absent", "not estimated"

# Display order codes for the second entity dimension.
WHO_REGION_ORDER = {"AMRO": 101, "EURO": 102, "SEARO": 103, "EMRO": 104, "AFRO": 105, "WPRO": 106}
WHO_REGION_ORDER_DEFAULT = 109
STATE_REGION_ORDER = {
    "East Asia and the Pacific": 1,
    "Europe and Eurasia": 2,
    "Near East (Middle East and Northern Africa)": 3,
    "South and Central Asia": 4,
    "Sub-Saharan Africa": 5,
    "Western Hemisphere": 6,
    "US": 7,
    "Non-State Region": 9,
}
STATE_REGION_ORDER_DEFAULT = 8
INCOME_ORDER = {
    "High income": 201,
    "Upper middle income": 202,
    "Lower middle income": 203,
    "Low income": 204,
    "Not classified": 209,
}
INCOME_ORDER_DEFAULT = 205

# ---------------------------------------------------------------------------------------


def ladder(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """``case_when``: the first true condition wins; null conditions count as false."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if expr is None:
        return F.lit(default)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def lookup(c, mapping: dict, default=None) -> Column:
    """Named-vector lookup for a literal mapping; missing key -> ``default`` (null)."""
    c = col_of(c)
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[x for kv in mapping.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    got = F.try_element_at(m, c)
    return got if default is None else F.coalesce(got, F.lit(default))


def cut_right_closed(c, breaks: Sequence[float]) -> Column:
    """R ``cut(x, c(b0, b1, ..., bk, Inf))`` bin number: ``(b_{i-1}, b_i]`` -> i.

    A value at or below ``b0`` (and null) is outside every bin and gives null.  Counting the
    breaks strictly below the value gives the right-closed bin; ``Bucketizer`` is
    left-closed, so it is not used.
    """
    c = col_of(c)
    arr = F.array(*[F.lit(float(b)) for b in breaks])
    n = F.size(F.filter(arr, lambda b: b < c.cast("double")))
    return F.when(c.isNotNull() & (n > 0), n.cast("int"))


def change_class_index(p) -> Column:
    """1..6 for the change classes: cuts -Inf,-.5,-.1,0,.1,1,Inf, right-closed, lowest closed."""
    p = col_of(p)
    branches = [(p <= cut, i + 1) for i, cut in enumerate(CHANGE_CUTS)]
    return F.when(p.isNull(), F.lit(None).cast("int")).otherwise(ladder(branches, 6).cast("int"))


def change_class_label(p) -> Column:
    idx = change_class_index(p)
    return lookup(idx, dict(enumerate(CHANGE_LABELS, start=1)))


def change_class_code(p) -> Column:
    idx = change_class_index(p)
    return lookup(idx, dict(enumerate(CHANGE_CODES, start=1)))


def quantile_class_index(v, q: Sequence[Column]) -> Column:
    """Class 1..6 against five cut points with first-match tie rules.

    ``v < q1`` -> 1; ``v = q_{k-1} or v < q_k`` -> k (k = 2..5); ``v >= q5`` -> 6.  A null
    value, or null cut points (no positive value in the group), give null ("absent").
    """
    v = col_of(v)
    q1, q2, q3, q4, q5 = q
    return ladder(
        [
            (v < q1, 1),
            ((v == q1) | ((v >= q1) & (v < q2)), 2),
            ((v == q2) | ((v >= q2) & (v < q3)), 3),
            ((v == q3) | ((v >= q3) & (v < q4)), 4),
            ((v == q4) | ((v >= q4) & (v < q5)), 5),
            (v >= q5, 6),
        ],
        None,
    ).cast("int")


def coverage_bin(c) -> tuple[Column, Column]:
    """(label, order) for coverage percentages, left-closed ``[a, b)``."""
    c = col_of(c)
    label_branches = [(c.isNull(), COVERAGE_NO_DATA)] + [(c < ub, lab) for ub, lab in COVERAGE_BINS]
    order_branches = [(c.isNull(), 0)] + [(c < ub, i + 1) for i, (ub, _) in enumerate(COVERAGE_BINS)]
    top = len(COVERAGE_BINS) + 1
    return ladder(label_branches, COVERAGE_TOP), ladder(order_branches, top).cast("int")


def sparse_label(indicator, period_label) -> Column:
    """``"<10 <Indicator> in past <period>"``."""
    return F.concat(F.lit(SPARSE_PREFIX), col_of(indicator), F.lit(SPARSE_MIDDLE), col_of(period_label))


def incidence_class(curr, incidence, indicator, period_label, threshold: float = 10) -> Column:
    """Incidence class (D14): sparse text below ``threshold`` counts, else Low..High."""
    curr, inc = col_of(curr), col_of(incidence)
    branches = [(curr < threshold, sparse_label(indicator, period_label)), (inc < INCIDENCE_CLASSES[0][0], INCIDENCE_LOW)]
    for i, (lo, lab) in enumerate(INCIDENCE_CLASSES):
        hi = INCIDENCE_CLASSES[i + 1][0] if i + 1 < len(INCIDENCE_CLASSES) else None
        cond = inc >= lo if hi is None else (inc >= lo) & (inc < hi)
        branches.append((cond, lab))
    return ladder(branches, None)


def direction_class(curr, pct_clean, threshold: float = 10) -> Column:
    """Direction class (D15) on the capped percent change."""
    curr, p = col_of(curr), col_of(pct_clean)
    dec, mdec, minc, inc = DIRECTION_LABELS
    return ladder(
        [
            (curr < threshold, DIRECTION_NA),
            (p <= -10, dec),
            ((p > -10) & (p < 0), mdec),
            ((p >= 0) & (p < 10), minc),
            (p >= 10, inc),
        ],
        None,
    )


def incidence_simple(curr, inc_cat, indicator, period_label, threshold: float = 10) -> Column:
    c = col_of(inc_cat)
    branches = [(col_of(curr) < threshold, sparse_label(indicator, period_label))]
    branches += [(c.isin(*members), label) for label, members in INCIDENCE_SIMPLE.items()]
    return ladder(branches, None)


def direction_simple(direction) -> Column:
    d = col_of(direction)
    branches = [(d == DIRECTION_NA, DIRECTION_NA)]
    branches += [(d.isin(*members), label) for label, members in DIRECTION_SIMPLE.items()]
    return ladder(branches, None)


def trajectory_class(curr, inc_simple, dir_simple, indicator, period_label, threshold: float = 10) -> Column:
    """Combined 2x2 trajectory."""
    i, d = col_of(inc_simple), col_of(dir_simple)
    branches = [(col_of(curr) < threshold, sparse_label(indicator, period_label))]
    branches += [((i == a) & (d == b), label) for (a, b), label in TRAJECTORY_LABELS.items()]
    return ladder(branches, None)


def order_code(c, mapping: dict, default) -> Column:
    """Display order code with a default for unknown / null values."""
    return lookup(c, mapping, default)
