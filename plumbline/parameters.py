"""Methodology parameters as DataFrames, their expectations, and the stamp that goes on every published value."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lead windows in days, booking curves and floors of the published methodology.
WINDOWS = (1, 7, 15, 30)
CURVES = {
    "central": (0.08, 0.27, 0.35, 0.30),
    "front_loaded": (0.15, 0.35, 0.30, 0.20),
    "back_loaded": (0.04, 0.18, 0.33, 0.45),
}
STRATUM_FLOOR, HEADLINE_FLOOR, OUTLIER_Z, MIN_WEIGHT_COVERAGE = 0.60, 0.75, 3.5, 0.9
#: Fare classes that never reach the headline: filed tariffs, and offers whose date the source chose.
NON_HEADLINE = ("filed_floor", "filed_base", "uncontrolled_lead")
SERIES_SMOOTH, SERIES_RAW, SERIES_WINDOW = "composite", "composite.raw", "window"


@dataclass(frozen=True)
class Methodology:
    carriers: tuple[str, ...]
    curves: dict[str, tuple[float, ...]] = field(default_factory=lambda: dict(CURVES))
    windows: tuple[int, ...] = WINDOWS
    stratum_floor: float = STRATUM_FLOOR
    headline_floor: float = HEADLINE_FLOOR
    outlier_z: float = OUTLIER_Z

    def curve_table(self, spark: SparkSession) -> DataFrame:
        rows = [(n, w, float(x)) for n, ws in self.curves.items() for w, x in zip(self.windows, ws)]
        return spark.createDataFrame(rows, "curve string, apd int, curve_weight double")

    def carrier_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c,) for c in self.carriers], "carrier string")

    def param_table(self, spark: SparkSession) -> DataFrame:
        p = {"stratum_floor": self.stratum_floor, "headline_floor": self.headline_floor, "outlier_z": self.outlier_z}
        p |= {f"curve.{n}.{w}": x for n, ws in self.curves.items() for w, x in zip(self.windows, ws)}
        p |= {f"carrier.{c}": 1.0 for c in self.carriers}
        return spark.createDataFrame([(k, repr(float(v))) for k, v in p.items()], "key string, value string")


def stamp(params: DataFrame) -> DataFrame:
    """One row: config_hash over the sorted key=value pairs, whatever their order."""
    pairs = F.array_sort(F.collect_list(F.concat_ws("=", "key", "value")))
    return params.agg(F.sha2(F.concat_ws("\n", pairs), 256).alias("config_hash"))


def stamped(df: DataFrame, params: DataFrame, computed_on: str) -> DataFrame:
    """df with config_hash and vintage_id on every row; the stamp is one row, so the join is a broadcast of it."""
    one = stamp(params).withColumn("vintage_id", F.concat(F.lit(f"{computed_on}-"), F.substring("config_hash", 1, 12)))
    return df.crossJoin(F.broadcast(one))


def curve_violations(curves: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """(curve, problem): curves that miss or repeat a window, have another one, or do not add up to 1."""
    want = F.array(*[F.lit(w) for w in sorted(windows)])
    by = curves.groupBy("curve").agg(F.sum("curve_weight").alias("total"), F.array_sort(F.collect_list("apd")).alias("have"))
    problem = F.when(F.col("have") != want, "windows").when(F.abs(F.col("total") - 1) > 1e-6, "sum")
    return by.withColumn("problem", problem).filter("problem is not null").select("curve", "problem")
