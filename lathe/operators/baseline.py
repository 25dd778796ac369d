"""Group-mean regressor: predicts the training mean of the label per group.

The stand-in learner whose predictions SQL can recompute. ``fit`` is one
partially aggregated ``groupBy``; ``transform`` is an equi-join on the group
columns (null-safe, so a missing group value is a group of its own) with the
global training mean as fallback for groups not seen in training. Up to
``BROADCAST_GROUPS`` groups (counted in the fit) the means are a fitted statistic
and are broadcast, so the scored table is not shuffled by its few hot groups;
beyond that the means stay a table and AQE picks the join and splits its skew.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups whose means may come to the driver and be broadcast.
BROADCAST_GROUPS = 10_000


@dataclass
class GroupMeanModel:
    group_by: tuple[str, ...]
    means: DataFrame | None
    global_mean: float | None
    small: bool = False

    def transform(self, df: DataFrame, pred: str = "prediction") -> DataFrame:
        fallback = F.lit(self.global_mean).cast("double")
        if not self.group_by:
            return df.withColumn(pred, fallback)
        m = self.means.select(*[F.col(c).alias(f"_gm_{c}") for c in self.group_by], F.col("_mean"))
        m = F.broadcast(m) if self.small else m
        cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(m[f"_gm_{c}"]) for c in self.group_by])
        joined = df.join(m, cond, "left")
        return joined.withColumn(pred, F.coalesce(F.col("_mean"), fallback)).drop(
            "_mean", *[f"_gm_{c}" for c in self.group_by]
        )


def fit_group_mean(df: DataFrame, label: str, group_by: list[str] | tuple[str, ...] = ()) -> GroupMeanModel:
    y = F.col(label).cast("double")
    g = tuple(group_by)
    global_mean = df.agg(F.avg(y)).collect()[0][0]
    means = df.groupBy(*g).agg(F.avg(y).alias("_mean")) if g else None
    if means is None:
        return GroupMeanModel(g, None, global_mean)
    first = means.limit(BROADCAST_GROUPS + 1).collect()
    small = len(first) <= BROADCAST_GROUPS
    if small:
        means = df.sparkSession.createDataFrame(first, means.schema)
    return GroupMeanModel(g, means, global_mean, small)
