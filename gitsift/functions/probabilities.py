"""Class probabilities: best class, maps, ordered views, one-hot rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gitsift import fixed_values as fv


def class_array() -> Column:
    return F.array(*map(F.lit, fv.TARGET_CLASSES))


def grid(value: Column) -> Column:
    """Value on a 1e-12 grid, so that summing order cannot decide a tie."""
    return F.rint(value * 1e12)


def argmax(probs: Column) -> Column:
    """Index of the largest probability, the lowest index on a tie."""
    snapped = F.transform(probs, grid)
    return (F.array_position(snapped, F.array_max(snapped)) - 1).cast("int")


def best(probs: Column) -> Column:
    """``struct<label, confidence>`` of the most probable class."""
    index = argmax(probs)
    return F.struct(
        F.get(class_array(), index).alias("label"), F.get(probs, index).alias("confidence")
    )


def as_map(probs: Column, decimals: int | None = None) -> Column:
    values = probs if decimals is None else F.transform(probs, lambda p: F.round(p, decimals))
    return F.map_from_arrays(class_array(), values)


def as_json(probs: Column, decimals: int | None = None) -> Column:
    return F.to_json(as_map(probs, decimals))


def ordered(probs: Column) -> Column:
    """``array<struct<label, p>>``, most probable first, class order on a tie."""
    pairs = F.transform(
        probs,
        lambda p, i: F.struct((-p).alias("neg"), i.alias("i"), F.get(class_array(), i).alias("label")),
    )
    return F.transform(
        F.array_sort(pairs),
        lambda s: F.struct(s["label"].alias("label"), (-s["neg"]).alias("p")),
    )


def one_hot(label: Column) -> Column:
    """1.0 at the label's class; anything else counts as the fallback class."""
    from gitsift.operators.cleaning import or_fallback

    known = or_fallback(label)
    return F.transform(class_array(), lambda c: (c == known).cast("double"))
