"""Running sums along the places of a key, in stretches, so that no key is ever gathered in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places in a stretch. Windows sort a stretch at most; sums of stretches are one row each.
STRETCH = 1024


def running(rows: DataFrame, key: str, place: str, values: dict[str, Column], stretch: int = STRETCH) -> DataFrame:
    """rows with the sum of each value over the smaller places of the key; places are distinct within a key.

    Sums by stretch are combined before the shuffle; the window over a key's
    stretches has a row for each, the other one only the rows of one stretch.
    """
    at = rows.withColumn("_stretch", F.floor(F.col(place) / stretch))
    at = at.withColumns({f"_v_{n}": v for n, v in values.items()})
    cells = at.groupBy(key, "_stretch").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    order = Window.partitionBy(key).orderBy("_stretch")
    before = cells.select(key, "_stretch", *[(F.sum(f"_s_{n}").over(order) - F.col(f"_s_{n}")).alias(f"_b_{n}") for n in values])
    inside = Window.partitionBy(key, "_stretch").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    joined = at.join(before, [key, "_stretch"])
    sums = {n: (F.col(f"_b_{n}") + F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0))).cast("long") for n in values}
    return joined.select(*rows.columns, *[s.alias(n) for n, s in sums.items()])
