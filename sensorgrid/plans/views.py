"""Tables behind the reference's plots and manual steps (W14, W15, P15,
M15, M16, A19, T5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import catalog
from ..operators import ordered, scalar, timeops

# The stored view sets of the exploration step, each a list of
# ``"columns--range"`` specs over the combined feed.
NAMED_VIEW_SETS: dict[str, tuple[str, ...]] = {
    "1": (
        "Temperature (F),Pressure (mbar),TotalMotion--2020-07-10 07:00:00,2020-07-10 22:00:00",
        "Temperature (F),Pressure (mbar),TotalMotion--2020-07-10 07:00:00,2020-07-11 22:00:00",
        "Temperature (F),Pressure (mbar),TotalMotion--2020-07-10 07:00:00,2020-07-12 22:00:00",
        "Temperature (F),Pressure (mbar),TotalMotion--2020-07-10 07:00:00,2020-07-16 22:00:00",
        "Temperature (F),Pressure (mbar),TotalMotion--2020-07-10 07:00:00,2020-08-10 22:00:00",
    ),
    "2": (
        "Temperature (F),Avg. RF Watts (W),TotalMotion--2020-06-10 07:00:00,2020-06-10 22:00:00",
        "Temperature (F),Avg. RF Watts (W),TotalMotion--2020-06-10 07:00:00,2020-06-12 22:00:00",
    ),
    "3": (
        "Temperature (F),Wind Speed (MPH),TotalMotion--2020-09-10 07:00:00,2020-09-10 22:00:00",
        "Temperature (F),Wind Speed (MPH),TotalMotion--2020-09-10 07:00:00,2020-09-12 22:00:00",
    ),
    "4": (
        "Wind Speed (MPH),Pressure (mbar)--2020-09-10 07:00:00,2020-09-10 22:00:00",
        "Wind Speed (MPH),Pressure (mbar)--2020-09-10 07:00:00,2020-09-12 22:00:00",
        "Wind Speed (MPH),Pressure (mbar)--2020-09-10 07:00:00,2020-09-16 22:00:00",
    ),
    "5": (
        "Precipitation (Inches),Pressure (mbar)--2020-09-10 07:00:00,2020-09-10 22:00:00",
        "Precipitation (Inches),Pressure (mbar)--2020-09-10 07:00:00,2020-09-16 22:00:00",
        "Precipitation (Inches),Pressure (mbar),TotalMotion--2020-08-10 07:00:00,2020-09-10 22:00:00",
    ),
}


def plot_ready(df: DataFrame, target: str, columns: Sequence[str] | None = None, time_range: str | None = None,
               night_start: str | None = catalog.NIGHT_START_EXPLORE, night_end: str = catalog.NIGHT_END,
               ts: str = "ts") -> DataFrame:
    """Nights removed → slice → select → min/max scaling with
    constant → 0 (W8), long form ``(ts, series, scaled, target_scaled)``:
    the target paired with each of ``columns`` (None: with every other
    numeric column that is no id)."""
    if columns is None:
        ids = set(catalog.id_columns(df.columns)) | {ts, target}
        columns = [f.name for f in df.schema.fields if f.name not in ids
                   and f.dataType.typeName() in ("double", "float", "long", "integer", "short")]
    d = df
    if night_start:
        d = timeops.exclude_nights(d, night_start, night_end, ts)
    d = timeops.time_range(d, time_range, ts).select(ts, target, *columns)
    d = ordered.minmax_scale(d, [target, *columns], constant="zero")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("scaled")) for c in columns]))
    return d.select(ts, F.col(target).alias("target_scaled"), pairs.alias("__p")).select(
        ts, "__p.series", "__p.scaled", "target_scaled")


def augment(df: DataFrame, selection: str, ts: str = "ts", target: str = catalog.TARGET,
            wind: str = "wind_speed_mph") -> DataFrame:
    """W15: "1" → running day sum of the target, "2" → wind threshold,
    anything else → unchanged."""
    if selection == "1":
        return ordered.running_day_sum(df, target, ts=ts, out=f"{target}_sum")
    if selection == "2":
        return scalar.threshold_to_zero(df, wind, 3.0)
    return df


def explore_correlations(df: DataFrame, methods: Sequence[str] = ("pearson", "kendall", "spearman"),
                         augmentation: str | None = None, nights: bool = False, time_range: str | None = None,
                         ts: str = "ts", columns: Sequence[str] | None = None) -> DataFrame:
    """The exploration chain behind the correlation heat maps: augmentation
    first (in place, before anything else), night removal, slice, id
    columns dropped, then one long-form matrix per method."""
    from ..operators import stats
    d = augment(df, augmentation, ts) if augmentation else df
    if nights:
        d = timeops.exclude_nights(d, catalog.NIGHT_START_EXPLORE, catalog.NIGHT_END, ts)
    d = timeops.time_range(d, time_range, ts)
    d = scalar.drop_columns(d, catalog.id_columns(d.columns))
    cols = list(columns) if columns is not None else [
        f.name for f in d.schema.fields if f.name != ts
        and f.dataType.typeName() in ("double", "float", "long", "integer")]
    fns = {"pearson": stats.corr_pearson, "spearman": stats.corr_spearman, "kendall": stats.corr_kendall}
    out = None
    for m in methods:
        r = fns[m](d, cols)
        out = r if out is None else out.unionByName(r)
    return out


def views(df: DataFrame, specs: Sequence[str] | str, ts: str = "ts") -> list[DataFrame]:
    """Several specs, or a named set of them, over one (persisted)
    source."""
    return [scalar.view(df, s, ts) for s in (NAMED_VIEW_SETS[specs] if isinstance(specs, str) else specs)]


def grouping_curve(results: DataFrame) -> DataFrame:
    """R² and CI span by grouping hours (the table behind the plot)."""
    return (results
            .select(F.element_at("data_periodicity_hrs", 1).alias("time_grouping_hours"),
                    F.col("r2_score").alias("r2"), F.col("ci95_span").alias("ci95_span"))
            .orderBy("time_grouping_hours"))


def actual_vs_predicted(pred: DataFrame, ts: str = "ts", label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """Actual, predicted, residual and squared error per test row."""
    r = F.col(label) - F.col(prediction)
    return pred.select(ts, F.col(label).alias("actual"), F.col(prediction).alias("predicted"),
                       r.alias("residual"), (r * r).alias("squared_error"))


def column_presence(ranked: DataFrame, columns: Sequence[str], top: int = 50,
                    partition: Sequence[str] = ()) -> DataFrame:
    """Of the best ``top`` models (by AICc, per result set), how many
    use any of ``columns``."""
    from ..operators.stats import best_models
    cand = F.array(*[F.lit(c) for c in columns])
    best = best_models(ranked, top, partition)
    uses = F.exists("input_columns", lambda c: F.array_contains(cand, c))
    return best.groupBy(*partition).agg(F.count(F.lit(1)).alias("n_models"),
                                        F.sum(uses.cast("int")).cast("bigint").alias("n_using"))
