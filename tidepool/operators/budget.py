"""Whole-number noise and a ledger of the privacy budget.

Two-sided geometric noise is the whole-number counterpart of Laplace noise: P(k) is proportional to
a^|k| with a = exp(-epsilon / sensitivity). It is drawn by inverting its distribution at a keyed uniform,
so no rounding of a real-valued draw gives anything away and a cell's noise can be repeated.

Every report is charged before it is made. Cells over disjoint rows (the labels of one summary) are one
charge of their largest epsilon (parallel composition); sections over the same rows add up (sequential
composition), and so do reports. A report that would exceed the budget is refused.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing
from tidepool.plans.joins import path_exists

CHARGES = "section string, part string, epsilon double"


class BudgetSpent(RuntimeError):
    """A report would cost more than is left."""


def two_sided_geometric(key: Column, epsilon: float = config.DP_EPSILON, seed: int = config.DP_SEED,
                        sensitivity: int = 1) -> Column:
    """Whole-number noise of a cell: the least k whose distribution reaches the cell's uniform."""
    u = hashing.unit_interval(F.concat(F.lit(f"{seed}|geometric|"), key))
    log_a = F.lit(-float(epsilon) / sensitivity)
    a = F.exp(log_a)
    below = -F.floor(F.log(u * (1 + a)) / log_a)
    above = F.greatest(F.ceil(F.log((F.lit(1.0) - u) * (1 + a)) / log_a) - 1, F.lit(0))
    return F.when(u < a / (1 + a), below).otherwise(above).cast("bigint")


def geometric_count(count: Column, key: Column, epsilon: float = config.DP_EPSILON, seed: int = config.DP_SEED) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.coalesce(count, F.lit(0)) + two_sided_geometric(key, epsilon, seed))


def report_cost(charges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., epsilon): the cost of charges (section, part, epsilon): within a section the largest over
    its parts of what is charged to a part; the sum over sections."""
    by = by or []
    parts = charges.groupBy(*by, "section", "part").agg(F.sum("epsilon").alias("e"))
    sections = parts.groupBy(*by, "section").agg(F.max("e").alias("e"))
    return sections.groupBy(*by).agg(F.round(F.sum("e"), 9).alias("epsilon"))


class Ledger:
    """Charges of the reports made so far, one folder each under ``path``. A report's name is charged once:
    asking again for the same charges is free, for others an error."""

    def __init__(self, path: str, total: float):
        self.path, self.total = path, total

    def _entry(self, report: str) -> str:
        return os.path.join(self.path, f"report={report}")

    def charges(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], CHARGES + ", report string")
        return spark.read.schema(CHARGES + ", report string").parquet(self.path)

    def spent(self, spark: SparkSession) -> float:
        per = report_cost(self.charges(spark), ["report"])
        return per.agg(F.coalesce(F.sum("epsilon"), F.lit(0.0))).first()[0]

    def charge(self, spark: SparkSession, report: str, charges: list[tuple[str, str, float]]) -> float:
        """Charge a report; returns what is left, or raises ``BudgetSpent`` and charges nothing."""
        if any(e < 0 for _, _, e in charges):
            raise ValueError("an epsilon cannot be negative")
        made = self.charges(spark).where(F.col("report") == report).select("section", "part", "epsilon").collect()
        if made:
            if sorted(map(tuple, made)) != sorted(charges):
                raise ValueError(f"report {report} was charged otherwise")
            return self.total - self.spent(spark)
        rows = spark.createDataFrame(charges, CHARGES)
        cost, spent = (report_cost(rows).first() or (0.0,))[0] or 0.0, self.spent(spark)
        if spent + cost > self.total + 1e-9:
            raise BudgetSpent(f"{report} costs {cost}, {self.total - spent} of {self.total} is left")
        rows.coalesce(1).write.mode("overwrite").parquet(self._entry(report))
        return self.total - spent - cost
