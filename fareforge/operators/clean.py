"""Cleaning rules and the curation sequence."""
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.bounded import lookup_join, settle
from ..functions.quantiles import group_quantiles
from ..functions.running import first_per_key
from ..functions.scalar import abs_seconds, all_present, count_if, is_blank, rounded, rows
from .checks import broken


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Unreadable numbers and NaN become null."""
    def one(name):
        number = F.col(name).try_cast("double")
        return F.when(~F.isnan(number), number)
    return df.withColumns({c: one(c) for c in columns if c in df.columns})


def coerce_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in columns if c in df.columns})


def text_columns_to_string(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def impute_sentinel(df: DataFrame, column: str = "FareID", sentinel: str = fixed.FARE_ID_SENTINEL) -> DataFrame:
    blank = is_blank(F.col(column))
    return df.withColumns({
        column: F.when(blank, F.lit(sentinel)).otherwise(F.col(column)),
        f"{column}WasImputed": blank,
    })


def fill_labels(df: DataFrame, columns: list[str], text: str = fixed.LABEL_SENTINEL) -> DataFrame:
    return df.fillna(text, subset=columns)


def above(value: Column, cap: Column) -> Column:
    return F.coalesce(value > cap, F.lit(False))


def cap_upper(value: Column, cap: Column) -> Column:
    """Null stays null."""
    return F.when(value > cap, cap).otherwise(value)


def not_nonpositive(column: str) -> Column:
    """False only for values at or below zero; null passes."""
    return ~F.coalesce(F.col(column) <= 0, F.lit(False))


def drop_missing_any(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def chronology_flags(max_gap: int = fixed.MAX_SCHEDULE_GAP_SECONDS) -> dict[str, Column]:
    """Three independent rules; a row may break more than one."""
    create, schedule, updated = F.col("Create"), F.col("Schedule"), F.col("Updated")
    no = F.lit(False)
    on_demand = F.coalesce(F.col("ScheduledRide"), F.lit(0)) == 0
    return {
        "invalid_create_or_schedule": create.isNull() | schedule.isNull(),
        "updated_before_create": F.coalesce(updated < create, no),
        "schedule_create_gap_gt_5m": F.coalesce(on_demand & (abs_seconds(create, schedule) > max_gap), no),
    }


@dataclass
class Thresholds:
    """Reference statistics: one row of medians and the global cap, and one cap per group."""
    overall: DataFrame
    by_group: DataFrame
    medians: list[str] = field(default_factory=list)


def thresholds(df: DataFrame, medians: list[str], group: str = "CategoryID", target: str = "Price",
               waiting: str = "WaitingTime") -> Thresholds:
    """Medians, the global cap and the per-group caps, all over rows with a positive target.

    One quantile pass over (feature, group, value) rows; the few result rows are settled once.
    """
    overall = list(dict.fromkeys([*medians, waiting]))
    everywhere = F.lit(None).cast(df.schema[group].dataType)
    values = [F.struct(F.lit(c).alias("feature"), everywhere.alias(group), F.col(c).cast("double").alias("value"))
              for c in overall]
    values.append(F.struct(F.lit(target).alias("feature"), F.col(group).alias(group),
                           F.col(target).cast("double").alias("value")))
    long = df.where(F.col(target) > 0).select(F.explode(F.array(*values)).alias("_r")).select("_r.*")
    q = settle(group_quantiles(long, ["feature", group], "value", {
        "median": 0.5, "waiting_cap": fixed.WAITING_CAP_QUANTILE, "target_cap": fixed.TARGET_CAP_QUANTILE}), "limits")
    of = lambda c, name: F.max(F.when(F.col("feature") == c, F.col(name)))
    one = q.agg(*[of(c, "median").alias(f"{c}_median") for c in medians], of(waiting, "waiting_cap").alias(f"{waiting}_cap"))
    by_group = q.where((F.col("feature") == target) & F.col(group).isNotNull()).select(
        group, F.col("target_cap").alias(f"{target}_cap"))
    return Thresholds(one, by_group, medians)


def uncapped_groups(df: DataFrame, caps: DataFrame, group: str) -> DataFrame:
    """Groups that have rows but no threshold."""
    return df.select(group).distinct().join(caps, group, "left_anti")


def cap_by_group(df: DataFrame, caps: DataFrame, value: str = "Price", group: str = "CategoryID",
                 cap: str = "Price_cap") -> DataFrame:
    """Cap at the group's threshold and flag; a row whose group has no threshold fails the run."""
    joined = lookup_join(df, caps, group)
    v, c = F.col(value), F.coalesce(F.col(cap), broken("group without a cap:", group).cast("double"))
    return joined.withColumns({f"{value}WasCapped": above(v, c), value: cap_upper(v, c)}).drop(cap)


# Columns that are read as numbers and times before anything else.
NUMBERS = ["WaitingTime", "Price", "Fee", "RidePrice"]
TIMES = ["Schedule", "Create", "Updated"]
REMOVALS = ["missing_coordinate", "nonpositive_price"]


def staged(df: DataFrame, coordinates: list[str], key: list[str], key_order: list) -> DataFrame:
    """Rows after deduplication with their rule flags."""
    return flag_removals(first_per_key(df, key, key_order), coordinates)


def flag_removals(kept: DataFrame, coordinates: list[str]) -> DataFrame:
    """One boolean per chronology rule and the first reason to remove the row."""
    flagged = kept.withColumns(chronology_flags())
    chronology = (F.col("invalid_create_or_schedule") | F.col("updated_before_create")
                  | F.col("schedule_create_gap_gt_5m"))
    reason = (F.when(chronology, "chronology").when(~all_present(*coordinates), "missing_coordinate")
              .when(~not_nonpositive("Price"), "nonpositive_price"))
    return flagged.withColumn("removed_by", reason)


def treat(df: DataFrame, limits: Thresholds, group: str = "CategoryID") -> DataFrame:
    """Imputation and capping of rows that passed every rule. `limits.overall` is read as a scalar."""
    overall = limits.overall
    numbers = {c: F.coalesce(F.col(c), overall.select(f"{c}_median").scalar()) for c in limits.medians}
    filled = impute_sentinel(df.withColumns({
        **{f"{c}WasImputed": F.col(c).isNull() for c in limits.medians}, **numbers}))
    cap = overall.select("WaitingTime_cap").scalar()
    waiting = F.col("WaitingTime")
    capped = filled.withColumns({
        "WaitingTimeWasCapped": above(waiting, cap), "WaitingTime": cap_upper(waiting, cap)})
    return cap_by_group(capped, limits.by_group, "Price", group)


def curate(df: DataFrame, coordinates: list[str], key: list[str], key_order: list, medians: list[str],
           fit_on: DataFrame | None = None) -> DataFrame:
    """Coerce, deduplicate, drop by rule, impute, cap, and leave out leakage and sparse columns. Thresholds come from all
    given rows, or from `fit_on`."""
    df = coerce_timestamps(coerce_numeric(df, NUMBERS), TIMES)
    limits = thresholds(df if fit_on is None else fit_on, medians)
    return drop_unused(finish(staged(df, coordinates, key, key_order), limits))


def finish(flagged: DataFrame, limits: Thresholds) -> DataFrame:
    """The rows that passed every rule, imputed and capped."""
    return treat(flagged.where("removed_by is null"), limits).drop("removed_by", *chronology_flags())


def drop_unused(df: DataFrame, columns=(*fixed.LEAKAGE_COLUMNS, *fixed.SPARSE_COLUMNS)) -> DataFrame:
    return df.drop(*columns)


def treatment_counts(source: DataFrame, staged_rows: DataFrame, treated: DataFrame) -> DataFrame:
    """One row with every count of a run. Three aggregates, each one pass."""
    before = source.agg(rows().alias("source_rows")).scalar()
    out = staged_rows.agg(
        rows().alias("deduplicated"),
        *[count_if(F.col(c)).alias(f"{c}_rows_removed") for c in chronology_flags()],
        *[count_if(F.col("removed_by") == r).alias(f"{r}_rows_removed") for r in REMOVALS],
        count_if(F.col("removed_by").isNull()).alias("rows_written"))
    imputed = [c for c in treated.columns if c.endswith("WasImputed")]
    capped = [c for c in treated.columns if c.endswith("WasCapped")]
    after = treated.agg(F.struct(
        *[count_if(F.col(c)).alias(c.replace("WasImputed", "_imputations")) for c in imputed],
        *[count_if(F.col(c)).alias(c.replace("WasCapped", "_rows_capped")) for c in capped])).scalar()
    full = out.withColumn("source_rows", before).withColumn("after", after).select("*", "after.*").drop("after")
    return full.withColumns({
        "duplicate_key_rows_removed": F.col("source_rows") - F.col("deduplicated"),
        "rows_removed_total": F.col("source_rows") - F.col("rows_written"),
        "retention_pct": rounded(F.try_divide(F.col("rows_written") * 100.0, F.col("source_rows"))),
    }).drop("deduplicated")


def as_metric_rows(one_row: DataFrame) -> DataFrame:
    """One row with n columns to n rows (metric, value)."""
    return one_row.unpivot([], [F.col(c).cast("double").alias(c) for c in one_row.columns], "metric", "value")
