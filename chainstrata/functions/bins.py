"""Label ladders: cohorts, eras, regimes. Labels carry an ordinal so empty ones can be kept."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Ladder:
    """Bin edges with one label per bin; values outside every bin get null.

    ``closed`` says which edge belongs to a bin. ``include_lowest`` also admits
    the very first edge of a right-closed ladder.
    """

    edges: Sequence[float]
    labels: Sequence[str]
    closed: str = "right"
    include_lowest: bool = False

    def __post_init__(self):
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("a ladder needs one more edge than labels")
        if self.closed not in ("left", "right"):
            raise ValueError("closed must be 'left' or 'right'")

    def _inside(self, value: Column, position: int) -> Column:
        low, high = F.lit(self.edges[position]), F.lit(self.edges[position + 1])
        if self.closed == "left":
            return (value >= low) & (value < high)
        above = value >= low if position == 0 and self.include_lowest else value > low
        return above & (value <= high)

    def label(self, value: Column) -> Column:
        out = None
        for position, name in enumerate(self.labels):
            test = self._inside(value, position)
            out = F.when(test, name) if out is None else out.when(test, name)
        return out

    def frame(self, spark: SparkSession, name: str, order: str = "ord") -> DataFrame:
        """The label dimension, a fixed handful of rows."""
        rows = [(label, position) for position, label in enumerate(self.labels)]
        return spark.createDataFrame(rows, f"{name} string, {order} int")


# The three published ladders.
AGE_COHORTS = Ladder(
    (0.0, 30.0, 90.0, 180.0, 365.0, 730.0, 1825.0, 3650.0, 99999.0),
    ("<1m", "1-3m", "3-6m", "6-12m", "1-2y", "2-5y", "5-10y", "10y+"),
    closed="left",
)
COIN_COHORTS = Ladder(
    (10.0, 50.0, 100.0, 500.0, 1000.0, 5000.0, 10000.0, 50000.0, 100000.0, 1e6),
    ("10-50", "50-100", "100-500", "500-1K", "1K-5K", "5K-10K", "10K-50K", "50K-100K", ">100K"),
)
ERAS = Ladder(
    (0, 100000, 200000, 300000, 400000, 500000, 600000, 700000, 800000, 900000, 1000000),
    ("2009-11", "2011-12", "2013-14", "2014-16", "2016-17",
     "2017-18", "2018-19", "2019-20", "2020-22", "2023-26"),
)

# Z-score bands.
REGIME_BAND = 1.5


def band_regime(z: Column, band: float = REGIME_BAND) -> Column:
    """elevated / depressed outside the band, else normal; a null z counts as normal."""
    return F.when(z > band, "elevated").when(z < -band, "depressed").otherwise("normal")


def step_regime(z: Column) -> Column:
    """Four-level z regime: 2 above two, 1 above one, -1 below minus one, else 0."""
    return F.when(z > 2.0, 2).when(z > 1.0, 1).when(z < -1.0, -1).otherwise(0)
