"""Classes for rooms, surfaces and prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrazzo.schemas import MAP_STEPS, SURFACE_CLASSES


def room_class(rooms: Column) -> Column:
    """Label for a number of rooms; missing, malformed, zero and one are all `studio_t1`.

    The shares in the gold table differ on purpose: there, zero and missing are in no class.
    """
    n = F.coalesce(rooms.try_cast("int"), F.lit(0))
    return (
        F.when(n <= 1, "studio_t1").when(n == 2, "t2").when(n == 3, "t3").when(n == 4, "t4").otherwise("t5_plus")
    )


def room_flags(rooms: Column) -> dict[str, Column]:
    """Membership tests of the gold room classes."""
    return {
        "part_studio_t1": rooms == 1, "part_t2": rooms == 2, "part_t3": rooms == 3,
        "part_t4": rooms == 4, "part_t5_plus": rooms >= 5,
    }


def _within(value: Column, low: float | None, high: float | None) -> Column:
    if low is None:
        return value < high
    return value >= low if high is None else (value >= low) & (value < high)


def surface_class(surface: Column) -> Column:
    """Label of the half-open surface class; null if the surface is missing or malformed."""
    value = surface.try_cast("double")
    value = F.when(~F.isnan(value), value)
    label = F.lit(None).cast("string")
    for name, _, low, high in reversed(SURFACE_CLASSES):
        label = F.when(_within(value, low, high), name).otherwise(label)
    return label


def surface_flags(surface: Column) -> dict[str, Column]:
    """Membership tests of the gold surface classes."""
    return {column: _within(surface, low, high) for _, column, low, high in SURFACE_CLASSES}


def price_step(price: Column) -> Column:
    """Step 0..3 of the map legend; null without a price."""
    step = F.lit(0)
    for number, bound in enumerate(MAP_STEPS, start=1):
        step = F.when(price >= bound, number).otherwise(step)
    return F.when(price.isNotNull(), step)
