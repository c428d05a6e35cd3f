"""Quality rules: base statistics of each text, and robust multivariate outliers.

Per language and source a minimum-covariance-determinant estimate of transformed statistics is
made by concentration: from medians, the nearest share of the documents gives a mean and a
covariance, which give new distances, and so on. Documents whose Mahalanobis distance is too
large are rejected. All of it is column expressions, grouped sums and joins.

Transformed statistics are whole numbers (in 1/SCALE), so sums don't depend on the order of
rows, and a group's percentiles count a bounded number of distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.frames import without
from millrace.session import stage

SCALE = 64
#: share of a group that each concentration step keeps
SUBSET = 0.75
STEPS = 3
#: groups with fewer documents get no estimate of their own
MIN_GROUP = 50
#: estimates of up to so many groups are broadcast
HELD_GROUPS = 1 << 14
#: least standard deviation of each feature, in units of the feature
FLOORS = {"f_length": 0.05, "f_words": 0.7, "f_symbols": 0.35, "f_lines": 0.7, "f_repeats": 0.5}
FEATURES = list(FLOORS)
_STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SPACE = r"[\\x20\\x09-\\x0D]"


def chi_square_cdf(x: float, dof: int) -> float:
    """For an odd number of degrees of freedom."""
    term, total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), 0.0
    for k in range(1, dof - 1, 2):
        total += term
        term *= x / (k + 2)
    return math.erf(math.sqrt(x / 2)) - total


def chi_square_point(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dof) < p else (low, middle)
    return (low + high) / 2


def consistency() -> float:
    """By how much the covariance of the nearest share of normal rows is too small."""
    d = len(FEATURES)
    return SUBSET / chi_square_cdf(chi_square_point(SUBSET, d), d + 2)


CUTOFF = chi_square_point(1 - 1e-6, len(FEATURES))


def add_statistics(docs: DataFrame) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, all long.

    Windows of three words are told apart by a hash of 63 bits less those of the text's length.
    """
    kept = [f"`{c}`" for c in docs.columns]
    text = "coalesce(text, '')"
    parts = docs.select(
        *kept,
        F.expr(f"filter(split({text}, '{_SPACE}+'), w -> w <> '')").alias("_words"),
        F.expr(f"filter(split({text}, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("_lines"),
        F.expr(f"length(regexp_replace({text}, '{_SPACE}+', ''))").cast("long").alias("word_chars"),
        F.expr(f"length({text}) - length(translate({text}, '#*$%&|<>', ''))").cast("long").alias("n_symbols"),
    )
    counted = parts.select(
        *kept, "_words", "word_chars", "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("length(bin(size(_words)))").alias("_bits"),
    )
    # a window's hash above its place, so that equal windows are neighbours once sorted
    sorted_windows = counted.withColumn("_sorted", F.expr(
        "sort_array(if(n_words < 3, array(), transform(sequence(0, cast(n_words as int) - 3), i ->"
        " shiftleft(xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)), _bits) | cast(i as bigint))))"
    )).drop("_words")
    places = sorted_windows.withColumn("_places", F.expr(
        "sort_array(transform(filter(_sorted, (v, i) ->"
        " (i > 0 and shiftright(v, _bits) = shiftright(coalesce(get(_sorted, i - 1), v), _bits)) or"
        " (i < size(_sorted) - 1 and shiftright(v, _bits) = shiftright(coalesce(get(_sorted, i + 1), v), _bits))),"
        " v -> v & (shiftleft(1L, _bits) - 1)))"
    ))
    covered = F.expr(
        "aggregate(transform(_places, (p, i) -> least(3L, coalesce(get(_places, i + 1), p + 3) - p)), 0L, (a, x) -> a + x)"
    )
    return places.withColumn("n_repeat_words", covered).select(*kept, *_STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _features() -> list[Column]:
    share = lambda c, of: F.log1p(100 * F.try_divide(F.col(c), F.col(of)))
    values = {
        "f_length": F.log(F.try_divide(F.col("word_chars"), F.col("n_words"))),
        "f_words": F.log("n_words"),
        "f_symbols": share("n_symbols", "word_chars"),
        "f_lines": F.log1p("n_dup_lines"),
        "f_repeats": share("n_repeat_words", "n_words"),
    }
    return [F.round(values[f] * SCALE).cast("long").alias(f) for f in FEATURES]


def _bucket(distance: Column) -> Column:
    """The distance on a logarithmic scale of whole numbers."""
    return F.round(SCALE * F.log(distance + 1e-3)).cast("long")


def _as_is(frame: DataFrame) -> DataFrame:
    return frame


def _nearest(rows: DataFrame, distance: Column, joined: Callable[[DataFrame], DataFrame] = _as_is) -> DataFrame:
    """The rows of each group's nearest share, those at its edge included."""
    placed = rows.withColumn("_bucket", _bucket(distance))
    edge = placed.groupBy("_group").agg(F.ceil(F.percentile("_bucket", F.lit(SUBSET))).alias("_edge"))
    return placed.join(joined(edge), "_group").filter("_bucket <= _edge")


def _estimates(nearest: DataFrame) -> DataFrame:
    """Mean and lower triangular root of the covariance, a row a group."""
    pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[: i + 1]]
    sums = nearest.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f).alias(f"_s_{f}") for f in FEATURES],
        *[F.sum(F.col(a) * F.col(b)).alias(f"_p_{a}_{b}") for a, b in pairs],
    )
    mean = {f: F.col(f"_s_{f}") / F.col("_n") for f in FEATURES}
    factor = consistency()
    frame = sums.select("_group", *[mean[f].alias(f"_m_{f}") for f in FEATURES], *[
        (factor * (F.col(f"_p_{a}_{b}") / F.col("_n") - mean[a] * mean[b])
         + F.lit((FLOORS[a] * SCALE) ** 2 if a == b else 0.0)).alias(f"_c_{a}_{b}")
        for a, b in pairs
    ])
    for i, a in enumerate(FEATURES):
        for j, b in enumerate(FEATURES[: i + 1]):
            rest = F.col(f"_c_{a}_{b}")
            for k in FEATURES[:j]:
                rest = rest - F.col(f"_r_{a}_{k}") * F.col(f"_r_{b}_{k}")
            frame = frame.withColumn(f"_r_{a}_{b}", F.sqrt(rest) if a == b else rest / F.col(f"_r_{b}_{b}"))
    return frame.select("_group", *[f"_m_{f}" for f in FEATURES], *[f"_r_{a}_{b}" for a, b in pairs])


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The rows with `_distance`, the squared Mahalanobis distance; null without an estimate."""
    joined = rows.join(estimates, "_group", "left")
    total = F.lit(0.0)
    for i, a in enumerate(FEATURES):
        left = F.col(a) - F.col(f"_m_{a}")
        for k in FEATURES[:i]:
            left = left - F.col(f"_r_{a}_{k}") * F.col(f"_y_{k}")
        joined = joined.withColumn(f"_y_{a}", left / F.col(f"_r_{a}_{a}"))
        total = total + F.col(f"_y_{a}") * F.col(f"_y_{a}")
    return joined.withColumn("_distance", total)


def _first_distance(rows: DataFrame, least: int, joined: Callable[[DataFrame], DataFrame] = _as_is) -> DataFrame:
    """Distances from the medians in units of the median deviation, for groups of at least so many rows."""
    middle = rows.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_n"), *[F.percentile(f, F.lit(0.5)).alias(f"_m_{f}") for f in FEATURES]
    )
    large = rows.join(joined(middle.filter(F.col("_n") >= least)), "_group")
    spread = large.groupBy("_group").agg(
        *[F.percentile(F.abs(F.col(f) - F.col(f"_m_{f}")), F.lit(0.5)).alias(f"_d_{f}") for f in FEATURES]
    )
    total = F.lit(0.0)
    for f in FEATURES:
        unit = 1.4826 * F.col(f"_d_{f}") + FLOORS[f] * SCALE
        total = total + F.pow((F.col(f) - F.col(f"_m_{f}")) / unit, 2)
    return large.join(joined(spread), "_group").select("_group", *FEATURES, total.alias("_distance"))


def _concentrated(rows: DataFrame, least: int, joined: Callable[[DataFrame], DataFrame] = _as_is) -> DataFrame:
    """The estimates of the groups of at least so many rows, after the concentration steps."""
    distances = _first_distance(rows, least, joined)
    for _ in range(STEPS):
        estimates = stage(_estimates(_nearest(distances, F.col("_distance"), joined)), "quality-estimates")
        distances = _distance(rows, joined(estimates)).filter("_distance is not null").select("_group", *FEATURES, "_distance")
    return estimates


def _borrowed(rows: DataFrame) -> DataFrame | None:
    """For each group of under MIN_GROUP rows the estimate of its language over all sources, or
    of all rows if the language has under MIN_GROUP rows too.

    A row a language and the row for everything are broadcast, so no language is one task's.
    """
    small = rows.groupBy("_group", "_lang").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < MIN_GROUP)
    small = stage(small.select(F.col("_group").alias("_small"), "_lang"), "quality-small")
    if small.isEmpty():
        return None
    of_lang = _concentrated(rows.select(F.col("_lang").alias("_group"), *FEATURES), MIN_GROUP, F.broadcast)
    found = small.join(F.broadcast(of_lang), small["_lang"] == of_lang["_group"])
    columns = [F.col("_small").alias("_group"), *[c for c in of_lang.columns if c != "_group"]]
    lent = found.select(*columns)
    rest = small.join(F.broadcast(of_lang), small["_lang"] == of_lang["_group"], "left_anti")
    if not rest.isEmpty():
        of_all = _concentrated(rows.select(F.lit("").alias("_group"), *FEATURES), 1, F.broadcast)
        lent = lent.unionByName(rest.join(F.broadcast(of_all), of_all["_group"] == "").select(*columns))
    return lent


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, distance (squared, null where none is made) and
    kept, a row for each row of docs (doc_id, text, lang, source).

    A null or empty text has no words and fails. A null language or source is a value of its own.
    A group of under MIN_GROUP rows that pass the base rules is judged by the estimate of its language
    over all sources, or of all rows if the language has as few, so that each such row gets a distance.
    Rows that repeat are judged alike, each counting in its group; rows as far as the edge of the
    nearest share belong to it; where all rows are equal the floors of the deviations stand. Only
    the text, language and source count. Texts have any length. An empty table gives an empty table.
    """
    docs = without(docs, *_STATISTICS, "base_failed", "distance", "kept")
    named = [F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("lang", "source")]
    group = F.concat_ws("\x00", *named)
    statistics = stage(
        add_statistics(docs.select("doc_id", "text", group.alias("_group"), named[0].alias("_lang"))).drop("text"),
        "quality-statistics",
    )
    judged = statistics.withColumn("base_failed", base_failed())
    rows = judged.filter("not base_failed").select("_group", "_lang", *_features())
    # the estimates of few groups go to every task, so a group with very many rows is no task's own
    few = rows.select("_group").distinct().limit(HELD_GROUPS + 1).count() <= HELD_GROUPS
    joined = F.broadcast if few else _as_is
    estimates = _concentrated(rows.drop("_lang"), MIN_GROUP, joined)
    lent = _borrowed(rows)
    if lent is not None:
        estimates = stage(estimates.unionByName(lent), "quality-all-estimates")
    measured = _distance(judged.select("*", *_features()), joined(estimates))
    distance = F.when(~F.col("base_failed"), F.col("_distance"))
    return measured.select(
        "doc_id", *_STATISTICS, "base_failed", distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))).alias("kept"),
    )
