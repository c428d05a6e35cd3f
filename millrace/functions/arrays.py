"""Column expressions over arrays of doubles; no rows are exploded."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bind(value: Column, body) -> Column:
    """`body(value)` with the value worked out once, however often the body uses it.

    A lambda over a one-element array holds the result; without it every use, also one
    inside another lambda, would evaluate the whole expression again.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(value: Column) -> Column:
    """A one-row generator for `value`, to be selected under an alias. Filters and
    projections further up then read the result; without this fence the optimizer copies
    the expression into each of them."""
    return F.explode(F.array(value))


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def array_mean(values: Column) -> Column:
    return bind(values, lambda v: F.try_divide(array_sum(v), F.size(v)))


def array_std(values: Column) -> Column:
    """Population standard deviation of one array."""

    def spread(v: Column) -> Column:
        squares = bind(
            array_mean(v),
            lambda mean: F.aggregate(
                v, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)
            ),
        )
        return F.sqrt(F.try_divide(squares, F.size(v)))

    return bind(values, spread)


def dot(left: Column, right: Column) -> Column:
    return array_sum(F.zip_with(left, right, lambda a, b: a * b))


def dots(values: Column, directions) -> Column:
    """Array of dot products of one array with several literal ones."""
    return bind(values, lambda v: F.array(*[dot(v, literal_array(d)) for d in directions]))


def literal_array(numbers) -> Column:
    return F.array(*[F.lit(float(number)) for number in numbers])


def rescale(series: Column) -> Column:
    """(x - mean) / mean per element; NULL elements when the mean is zero."""
    return bind(
        series,
        lambda s: bind(
            array_mean(s), lambda m: F.transform(s, lambda x: F.try_divide(x - m, m))
        ),
    )


def fold(series: Column, period: int) -> Column:
    """Sum of every `period`-th element, one total per phase."""

    def phases(s: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(period - 1)),
            lambda phase: F.aggregate(
                F.sequence(phase, F.size(s) - 1, F.lit(period)),
                F.lit(0.0),
                lambda acc, pos: acc + F.get(s, pos),
            ),
        )

    return bind(series, phases)


def block_sums(series: Column, run: int) -> Column:
    """Sum of each run of `run` neighbouring elements."""

    def blocks(s: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), (F.size(s) / run).cast("int") - 1),
            lambda block: array_sum(F.slice(s, block * run + 1, run)),
        )

    return bind(series, blocks)


def interactions(features: Column) -> Column:
    """The features followed by every ordered product of two of them."""
    return bind(
        features,
        lambda f: F.concat(
            f, F.flatten(F.transform(f, lambda a: F.transform(f, lambda b: a * b)))
        ),
    )


def gradient_summand(weights: Column, features: Column, label: Column) -> Column:
    """One row's least-squares gradient: (w.x - y) x."""
    return bind(
        features,
        lambda f: bind(dot(weights, f) - label, lambda r: F.transform(f, lambda x: r * x)),
    )


def centred(features: Column, means: Column) -> Column:
    return F.zip_with(features, means, lambda x, m: x - m)


def project_back(features: Column, means: Column, component: Column) -> Column:
    """Projection of each row onto one direction through the mean point."""
    share = F.try_divide(dot(centred(features, means), component), dot(component, component))
    return bind(share, lambda s: F.zip_with(component, means, lambda c, m: s * c + m))
