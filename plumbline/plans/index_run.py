"""The index run from quotes to stacked series, and its report."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import eligibility, panel, relatives, smooth
from ..operators.weights import active
from ..parameters import SERIES_RAW, SERIES_SMOOTH, SERIES_WINDOW, Methodology
from .spool import stored_with


class IndexRun:
    """The stages of a run. Those that several others read (observations, relatives, panel) are computed when one is first asked
    for and kept in the shared folder; everything else stays a plan on top of them."""

    def __init__(self, quotes: DataFrame, routes: DataFrame, method: Methodology, start: str | None = None, end: str | None = None):
        self.quotes, self.routes, self.method, self.start, self.end = quotes, active(routes), method, start, end
        self.spark, self.counts = quotes.sparkSession, {}

    def _stored(self, df: DataFrame, name: str, **metrics) -> DataFrame:
        """The stage, written once; what report() says of it is observed by the write."""
        out, seen = stored_with(df, name, metrics)
        self.counts |= seen
        return out

    @cached_property
    def obs(self) -> DataFrame:
        df = eligibility.observations(self.quotes, self.start, self.end)
        return self._stored(df, "observations", n_observations=F.count("*"), base_period=F.min("period"), n_periods=F.size(F.collect_set("period")).cast("long"))

    @cached_property
    def flagged(self) -> DataFrame:
        df = relatives.flag_outliers(relatives.build_relatives(self.obs), self.method.outlier_z)
        return self._stored(df, "relatives", n_relatives=F.count("*"), n_outliers=F.count_if("outlier"))

    @cached_property
    def filled(self) -> DataFrame:
        return relatives.impute(self.flagged, self.method.carrier_table(self.spark)) if self.method.carriers else self.flagged.withColumn("imputed", F.lit(False))

    @cached_property
    def panel(self) -> DataFrame:
        df = panel.elementary_panel(self.filled, len(self.method.carriers), self.method.stratum_floor)
        return self._stored(df, "panel", n_imputed=F.coalesce(F.sum("n_imputed"), F.lit(0)), n_panel_rows=F.count("*"), n_suppressed=F.count_if("suppressed"))

    @cached_property
    def weights(self) -> DataFrame:
        return panel.usable_weights(self.routes)

    @cached_property
    def upper(self) -> DataFrame:
        return panel.upper_level(self.panel, self.weights, self.method.curve_table(self.spark), len(self.method.windows))

    @cached_property
    def composite(self) -> DataFrame:
        return panel.composite(self.upper, self.method.headline_floor)

    @cached_property
    def windows(self) -> DataFrame:
        return panel.window_index(self.panel, self.weights, self.method.headline_floor)

    @cached_property
    def smoothed(self) -> DataFrame:
        return smooth.centred_mean(self.composite, ["value", "low", "high"])

    def series(self) -> DataFrame:
        """(series_id, frequency, period, value, coverage, suppressed, low, high): raw, by window, and smoothed."""
        none = F.lit(None).cast("double")
        cols = ["series_id", "frequency", "period", "value", "coverage", "suppressed", "low", "high"]
        daily = F.lit("daily").alias("frequency")
        raw = self.composite.select(F.lit(SERIES_RAW).alias("series_id"), daily, *cols[2:])
        one = self.windows.select(F.concat(F.lit(f"{SERIES_WINDOW}.T"), F.col("apd").cast("string")).alias("series_id"), daily, "period", "value", "coverage", "suppressed", none.alias("low"), none.alias("high"))
        mean = self.smoothed.select(F.lit(SERIES_SMOOTH).alias("series_id"), daily, *cols[2:])
        return raw.unionByName(one).unionByName(mean)

    @cached_property
    def stack(self) -> DataFrame:
        """series(), written once."""
        kind = F.col("series_id")
        counts = {"n_raw": kind == SERIES_RAW, "n_window": kind.startswith(f"{SERIES_WINDOW}.T"), "n_smoothed": kind == SERIES_SMOOTH}
        return self._stored(self.series(), "series", **{k: F.count_if(c) for k, c in counts.items()})

    def report(self, routes: DataFrame) -> DataFrame:
        """One row of counts and the warnings that say why a run publishes nothing or less than it could. The counts come from the
        writes of the stages; no stage is read again for them."""
        self.stack  # the last stage; those that it reads are written with it
        names = ["n_observations", "base_period", "n_periods", "n_relatives", "n_outliers", "n_imputed", "n_panel_rows", "n_suppressed", "n_raw", "n_window", "n_smoothed"]
        types = {"base_period": "date"}
        out = self.spark.createDataFrame([tuple(self.counts[k] for k in names)], ", ".join(f"{k} {types.get(k, 'bigint')}" for k in names))
        out = out.crossJoin(panel.weight_coverage(routes).select("weights_real", "weights_refused"))
        checks = {
            "no_observations": F.col("n_observations") > 0,
            "one_day_only": (F.col("n_observations") == 0) | (F.col("n_periods") > 1),
            "no_match": (F.col("n_periods") < 2) | (F.col("n_relatives") > 0),
            "all_suppressed": (F.col("n_panel_rows") == 0) | (F.col("n_raw") > 0),
            "equal_weights": F.col("weights_real") & ~F.col("weights_refused"),
            "weights_refused": ~F.col("weights_refused"),
            "no_complete_week": (F.col("n_raw") == 0) | (F.col("n_smoothed") > 0),
        }
        return out.withColumn("n_index_values", F.col("n_raw") + F.col("n_window") + F.col("n_smoothed")).withColumn("warnings", F.array_join(eligibility.violations(checks), ","))


def index_run(quotes: DataFrame, routes: DataFrame, method: Methodology, start: str | None = None, end: str | None = None) -> IndexRun:
    """quotes and the basket's routes(route_id, weight, active if it has it) -> every stage, nothing computed yet."""
    return IndexRun(quotes, routes, method, start, end)
