"""Two-sample tests between a reference and the current rows, one row per feature.

Numbers: the Kolmogorov-Smirnov test, the Wasserstein distance over the reference's
deviation, the Jensen-Shannon distance and PSI over the reference's bins. Categories:
the chi-square test of equal shares, for two categories also the z test of two shares,
the Jensen-Shannon distance and PSI; NULL is a category. All tests of a kind come from
the same counts, so choosing among them costs no pass.

A distance tells of drift from its threshold on; a test with a p-value below its threshold.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage_table
from .drift import (
    NOT_REPORTED,
    REF,
    WIN,
    Reference,
    bin_counts,
    categorical_psi_of,
    category_shares,
    fit_reference,
    mark,
    psi,
    unfold_cells,
    with_edges,
)
from .features import numeric_columns, text_columns
from .running import BUCKET, add_running, known, sums_before, value_splits

#: Which test decides for a kind of column; a column of two categories is binary.
TESTS: Mapping[str, str] = {"numeric": "wasserstein", "categorical": "jensen_shannon", "binary": "jensen_shannon"}
#: The choice for few rows, where p-values are not yet small for every little shift.
P_VALUE_TESTS: Mapping[str, str] = {"numeric": "ks", "categorical": "chi_square", "binary": "z"}
#: Distances from which, and p-values below which, a column counts as drifted.
DISTANCES: Mapping[str, float] = {"wasserstein": 0.1, "jensen_shannon": 0.1, "psi": 0.1}
P_VALUES: Mapping[str, float] = {"ks": 0.05, "chi_square": 0.05, "z": 0.05}
#: The reference's deviation counts as this much at least.
LEAST_DEVIATION = 0.001

RESULT = ("feature", "kind", "test", "statistic", "p_value", "n_reference", "n_current")


def _terms(n: int) -> Column:
    return F.sequence(F.lit(1), F.lit(n))


def upper_tail(t: Column) -> Column:
    """The complementary error function of t >= 0: its series below 3, its continued fraction from there on."""
    square = t * t
    start = F.struct(t.alias("term"), t.alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * 2 * square / (2 * k + 1)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    series = F.aggregate(_terms(80), start, step, lambda acc: acc["sum"])
    below = F.lit(1.0) - F.lit(2 / math.sqrt(math.pi)) * F.exp(-square) * series
    fraction = F.aggregate(F.reverse(_terms(60)), F.lit(0.0), lambda f, k: k / 2 / (t + f))
    above = F.exp(-square) / (F.lit(math.sqrt(math.pi)) * (t + fraction))
    return F.when(t < 3, below).otherwise(above)


def chi_square_p_value(x: Column, freedom: Column) -> Column:
    """P(chi-square with that many degrees of freedom >= x): a sum of freedom / 2 terms, in logarithms."""
    half, odd = x / 2, freedom % 2
    # First term: e^-h for even degrees, h^(1/2) e^-h / Gamma(3/2) for odd ones; each next one times h over its index.
    shift = odd.cast("double") / 2
    first = F.when(odd == 1, F.log(half) / 2 - F.lit(math.lgamma(1.5))).otherwise(F.lit(0.0)) - half
    start = F.struct(first.alias("log"), F.exp(first).alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["log"] + F.log(half) - F.log(k + shift)
        return F.struct(term.alias("log"), (acc["sum"] + F.exp(term)).alias("sum"))

    terms = F.floor((freedom - odd) / 2).cast("int")
    more = F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>"))
    rest = F.when(terms > 0, F.aggregate(more, start, step, lambda acc: acc["sum"])).otherwise(F.lit(0.0))
    found = rest + F.when(odd == 1, upper_tail(F.sqrt(half))).otherwise(F.lit(0.0))
    return F.when(freedom >= 1, F.when(x > 0, F.least(found, F.lit(1.0))).otherwise(F.lit(1.0)))


def normal_p_value(z: Column) -> Column:
    """Two-sided."""
    return upper_tail(F.abs(z) / math.sqrt(2))


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic p-value of the two-sample distance d over samples of n and m."""
    both = n.cast("double") * m.cast("double") / (n + m).cast("double")
    at = F.sqrt(both) * d
    term = lambda s, k: s + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * at * at)
    series = F.aggregate(_terms(40), F.lit(0.0), term)
    # Below 0.2 it is 1 to twelve digits, and the series needs many terms.
    return F.when(at < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def _long(df: DataFrame, tests: Mapping[str, tuple[Column, Column | None]]) -> DataFrame:
    none = F.lit(None).cast("double")
    rows = [
        F.struct(F.lit(name).alias("test"), s.cast("double").alias("statistic"), (none if p is None else p).alias("p_value"))
        for name, (s, p) in tests.items()
    ]
    return df.select("feature", "kind", "n_reference", "n_current", F.inline(F.array(*rows))).select(*RESULT)


def _distance(p: Column, q: Column) -> Column:
    """The part of the squared Jensen-Shannon distance of one bin with shares p and q."""
    part = lambda x: F.when(x > 0, x * F.log(2 * x / (p + q))).otherwise(F.lit(0.0))
    return (part(p) + part(q)) / 2


def _jensen_shannon(counts: DataFrame) -> DataFrame:
    """(feature, jensen_shannon) of counts (feature, n_reference, n_current), one row per bin; natural logarithm."""
    of = lambda c: F.try_divide(F.col(c).cast("double"), F.sum(c).over(W.partitionBy("feature")).cast("double"))
    shares = counts.select("feature", of("n_reference").alias("p"), of("n_current").alias("q")).where("p IS NOT NULL AND q IS NOT NULL")
    total = F.sum(_distance(F.col("p"), F.col("q")))
    return shares.groupBy("feature").agg(F.sqrt(F.greatest(total, F.lit(0.0))).alias("jensen_shannon"))


def _curves(cells, deviations: Mapping[str, float]) -> DataFrame:
    """(feature, n_reference, n_current, ks, wasserstein) along the values of both sides together.

    The area between both distribution functions is a sum over values: the functions'
    distance at a value times the way to the next one, which for the last value of a range
    is the first of the next range.
    """
    counts = cells.rows.groupBy("feature", BUCKET, "value").agg(
        F.sum(REF).alias("n_ref"), F.sum(F.lit(1) - F.col(REF)).alias("n_cur")
    )
    ranges = counts.groupBy("feature", BUCKET).agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"), F.min("value").alias("first")
    )
    whole = W.partitionBy("feature")
    offsets = ranges.select(
        "feature",
        BUCKET,
        *sums_before(["feature"], ["n_ref", "n_cur"]),
        F.sum("n_ref").over(whole).alias("n_reference"),
        F.sum("n_cur").over(whole).alias("n_current"),
        F.lead("first").over(whole.orderBy(BUCKET)).alias("beyond"),
    )
    along = W.partitionBy("feature", BUCKET).orderBy("value")
    # A feature that one side has no value of has no distance.
    curves = add_running(counts, offsets.where("n_reference > 0 AND n_current > 0"), ["feature"], "value", ["n_ref", "n_cur"])
    share = lambda c, n: F.col(c).cast("double") / F.col(n).cast("double")
    apart = F.abs(share("n_ref_run", "n_reference") - share("n_cur_run", "n_current"))
    way = F.coalesce(F.lead("value").over(along), F.col("beyond")) - F.col("value")
    found = curves.withColumns({"apart": apart, "way": F.coalesce(way, F.lit(0.0))}).groupBy("feature").agg(
        F.max("n_reference").alias("n_reference"),
        F.max("n_current").alias("n_current"),
        F.max("apart").alias("ks"),
        F.sum(F.col("apart") * F.col("way")).alias("area"),
    )
    # One number per feature.
    deviation = F.create_map(*[F.lit(x) for c, d in deviations.items() for x in (c, max(d or 0.0, LEAST_DEVIATION))])
    return found.withColumn("wasserstein", F.col("area") / F.element_at(deviation, F.col("feature")))


def numeric_tests(marked: DataFrame, ref: Reference) -> DataFrame:
    """All tests of the features of ``ref``; ``marked`` is best a stored frame, it is read three times."""
    spread = marked.where(F.col(REF) == 1).agg(*[F.expr(f"stddev_pop({known(c)}) AS s{i}") for i, c in enumerate(ref.features)]).first()
    cells = unfold_cells(marked, with_edges(ref, value_splits(marked, ref.features)))
    curves = _curves(cells, {c: spread[f"s{i}"] for i, c in enumerate(ref.features)})
    bins = bin_counts(ref, cells).groupBy("feature", "bin").agg(
        F.sum("n_ref").alias("n_reference"), F.sum(F.when(F.col(WIN).isNotNull(), F.col("n")).otherwise(0)).alias("n_current")
    )
    found = curves.join(_jensen_shannon(bins), "feature").join(psi(marked, ref, cells).drop("window"), "feature")
    ks = F.col("ks")
    tests = {
        "wasserstein": (F.col("wasserstein"), None),
        "jensen_shannon": (F.col("jensen_shannon"), None),
        "psi": (F.col("psi"), None),
        "ks": (ks, ks_p_value(ks, F.col("n_reference"), F.col("n_current"))),
    }
    return _long(found.withColumn("kind", F.lit("numeric")), tests)


def category_tests(shares: DataFrame) -> DataFrame:
    """All tests of category counts (feature, category, n_reference, n_current); binary are features with two categories."""
    total = lambda c: F.sum(c).over(W.partitionBy("feature")).cast("double")
    r, c = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    sized = shares.withColumns({"_r": total("n_reference"), "_c": total("n_current")})
    expected = (r + c) / (F.col("_r") + F.col("_c"))
    apart = F.try_divide(F.pow(r - expected * F.col("_r"), 2), expected * F.col("_r")) + F.try_divide(
        F.pow(c - expected * F.col("_c"), 2), expected * F.col("_c")
    )
    last = lambda x: F.max_by(x, F.struct("category"))
    found = sized.groupBy("feature").agg(
        F.max("_r").cast("long").alias("n_reference"),
        F.max("_c").cast("long").alias("n_current"),
        F.count("*").alias("categories"),
        F.sum(apart).alias("chi_square"),
        last(F.try_divide(r, F.col("_r"))).alias("share_r"),
        last(F.try_divide(c, F.col("_c"))).alias("share_c"),
        last(F.try_divide(r + c, F.col("_r") + F.col("_c"))).alias("share"),
    )
    found = found.withColumn("kind", F.when(F.col("categories") == 2, "binary").otherwise("categorical"))
    joined = found.join(_jensen_shannon(shares), "feature").join(categorical_psi_of(shares).drop("categories"), "feature")
    one_over = lambda c: F.try_divide(F.lit(1.0), F.col(c))
    error = F.sqrt(F.col("share") * (1 - F.col("share")) * (one_over("n_reference") + one_over("n_current")))
    z = F.when(F.col("kind") == "binary", F.try_divide(F.col("share_c") - F.col("share_r"), error))
    tests = {
        "jensen_shannon": (F.col("jensen_shannon"), None),
        "psi": (F.col("psi"), None),
        "chi_square": (F.col("chi_square"), chi_square_p_value(F.col("chi_square"), F.col("categories") - 1)),
        "z": (z, normal_p_value(z)),
    }
    both = joined.where("n_reference > 0 AND n_current > 0")
    return _long(both, tests).where("test <> 'z' OR kind = 'binary'")


def all_tests(
    df: DataFrame, is_ref: Column, features: Sequence[str] | None = None, categories: Sequence[str] | None = None
) -> DataFrame:
    """(feature, kind, test, statistic, p_value, n_reference, n_current): every test of every column.

    The columns are stored once, narrow, and read from there. A column without values on
    one side has no rows.
    """
    if features is None:
        features = numeric_columns(df, NOT_REPORTED)
    if categories is None:
        categories = text_columns(df, NOT_REPORTED)
    ref_row = F.coalesce(is_ref, F.lit(False))
    narrow = mark(df, is_ref, F.when(~ref_row, F.lit("current"))).select(REF, WIN, *dict.fromkeys([*features, *categories]))
    narrow = stage_table(narrow, "halves")
    parts = []
    ref = fit_reference(narrow.where(F.col(REF) == 1), features)
    if ref.edges:
        parts.append(numeric_tests(narrow, ref))
    if categories:
        parts.append(category_tests(category_shares(narrow, F.col(REF) == 1, categories)))
    if not parts:
        raise ValueError("no column to test")
    return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]


def decide(
    tests: DataFrame, chosen: Mapping[str, str] = TESTS, distances: Mapping[str, float] = DISTANCES, p_values: Mapping[str, float] = P_VALUES
) -> DataFrame:
    """One row per feature: the test chosen for its kind, with its threshold and verdict."""
    wrong = [f"{t} for {k}" for k, t in chosen.items() if t not in {**distances, **p_values}]
    if wrong:
        raise ValueError(f"no threshold for {', '.join(wrong)}")
    picks = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
    limits = F.create_map(*[F.lit(x) for pair in {**distances, **p_values}.items() for x in pair])
    own = tests.where(F.col("test") == F.element_at(picks, F.col("kind"))).withColumn("threshold", F.element_at(limits, F.col("test")))
    by_p = F.col("test").isin(*p_values)
    return own.withColumn("drifted", F.when(by_p, F.col("p_value") < F.col("threshold")).otherwise(F.col("statistic") >= F.col("threshold")))
