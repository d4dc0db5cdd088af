"""Expanding time folds with a gap, on positions of observed dates."""
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scalar import count_if, rows
from .checks import ContractError, broken


@dataclass(frozen=True)
class SplitConfig:
    regime_start: str = fixed.REGIME_START
    n_splits: int = fixed.N_SPLITS
    test_days: int = fixed.TEST_DAYS
    gap_days: int = fixed.GAP_DAYS
    holdout_days: int = fixed.HOLDOUT_DAYS

    @property
    def min_dates(self) -> int:
        return self.holdout_days + self.gap_days + self.n_splits * self.test_days + self.gap_days + 1


@dataclass(frozen=True)
class SplitWindow:
    name: str
    split_type: str
    number: int
    train_start: date
    train_end: date
    gap_start: date | None
    gap_end: date | None
    evaluation_start: date
    evaluation_end: date


def temporal_frame(df: DataFrame, columns: list[str], regime_start: str = fixed.REGIME_START) -> DataFrame:
    """Rows of the regime with their creation date; the date filter reaches the scan as a range on Create."""
    start = F.lit(regime_start).cast("timestamp_ntz")
    return require_time(df).where(F.col("Create") >= start).select(*columns, F.to_date("Create").alias("CreateDate"))


def require_time(df: DataFrame) -> DataFrame:
    """The rows themselves; a row without a creation time fails the run before a filter could lose it."""
    return df.withColumn("Create", F.coalesce("Create", broken("null Create")))


def date_positions(frame: DataFrame, column: str = "CreateDate") -> DataFrame:
    """Distinct dates with position from the start and from the end. One row per calendar day at most."""
    days = frame.select(F.col(column).alias("day")).where("day is not null").distinct()
    return days.withColumns({
        "position": (F.row_number().over(Window.orderBy("day")) - 1).cast("bigint"),
        "from_end": (F.row_number().over(Window.orderBy(F.desc("day"))) - 1).cast("bigint")})


def coverage_guard(positions: DataFrame, config: SplitConfig) -> DataFrame:
    return positions.agg(rows().alias("observed_dates")).select(
        "observed_dates", F.lit(config.min_dates).cast("bigint").alias("required_dates"),
        (F.col("observed_dates") >= config.min_dates).alias("enough"))


def _bounds(config: SplitConfig) -> list[tuple[str, str, int, int, int]]:
    """(name, type, number, first and last evaluation position counted from the end)."""
    held = config.holdout_days + config.gap_days
    out = []
    for k in range(1, config.n_splits + 1):
        last = held + (config.n_splits - k) * config.test_days
        out.append((f"fold_{k}", "cv", k, last + config.test_days - 1, last))
    out.append(("holdout_test", "holdout", config.n_splits + 1, config.holdout_days - 1, 0))
    return out


def split_windows_frame(positions: DataFrame, config: SplitConfig) -> DataFrame:
    """The windows as rows, from one aggregate over the dates."""
    day, back = F.col("day"), F.col("from_end")

    def span(first_back: int | None, last_back: int) -> tuple[Column, Column]:
        inside = back >= last_back if first_back is None else back.between(last_back, first_back)
        picked = F.when(inside, day)
        return F.min(picked), F.max(picked)

    lines = []
    for name, kind, number, first, last in _bounds(config):
        train = span(None, first + config.gap_days + 1)
        gap = span(first + config.gap_days, first + 1) if config.gap_days else (F.lit(None).cast("date"),) * 2
        evaluation = span(first, last)
        lines.append(F.struct(
            F.lit(name).alias("split_name"), F.lit(kind).alias("split_type"), F.lit(number).alias("number"),
            train[0].alias("train_start"), train[1].alias("train_end"),
            gap[0].alias("gap_start"), gap[1].alias("gap_end"),
            evaluation[0].alias("evaluation_start"), evaluation[1].alias("evaluation_end")))
    return positions.agg(F.array(*lines).alias("_a"), rows().alias("dates")).select(F.inline("_a"), "dates")


def split_windows(frame: DataFrame, config: SplitConfig = SplitConfig(), column: str = "CreateDate") -> list[SplitWindow]:
    """The windows as a short driver-side list, so that folds become date literals in later plans."""
    found = split_windows_frame(date_positions(frame, column), config).collect()
    if found[0].dates < config.min_dates:
        raise ContractError(f"{found[0].dates} dates observed, {config.min_dates} needed")
    return [SplitWindow(*row[:-1]) for row in found]


def train_from(windows: list[SplitWindow], column: str = "CreateDate") -> Column:
    """Number of the first window that trains on the date. Windows expand, so later ones do too."""
    d = F.col(column)
    out = None
    for w in sorted(windows, key=lambda w: w.number):
        inside = d.between(F.lit(w.train_start), F.lit(w.train_end))
        out = F.when(inside, w.number) if out is None else out.when(inside, w.number)
    return out


def evaluated_in(windows: list[SplitWindow], column: str = "CreateDate") -> Column:
    """Number of the window that evaluates the date; evaluation spans do not overlap."""
    d = F.col(column)
    out = None
    for w in windows:
        inside = d.between(F.lit(w.evaluation_start), F.lit(w.evaluation_end))
        out = F.when(inside, w.number) if out is None else out.when(inside, w.number)
    return out


def mark_folds(frame: DataFrame, windows: list[SplitWindow]) -> DataFrame:
    """Two small numbers per row instead of one copy of the row per window."""
    return frame.withColumns({"train_from": train_from(windows), "evaluated_in": evaluated_in(windows)})


def role_in(w: SplitWindow, column: str = "CreateDate") -> Column:
    d = F.col(column)
    role = F.when(d.between(F.lit(w.train_start), F.lit(w.train_end)), "train")
    if w.gap_start is not None:
        role = role.when(d.between(F.lit(w.gap_start), F.lit(w.gap_end)), "gap")
    return role.when(d.between(F.lit(w.evaluation_start), F.lit(w.evaluation_end)), "eval")


def train_rows(frame: DataFrame, w: SplitWindow, column: str = "CreateDate") -> DataFrame:
    return frame.where(F.col(column).between(F.lit(w.train_start), F.lit(w.train_end)))


def evaluation_rows(frame: DataFrame, w: SplitWindow, column: str = "CreateDate") -> DataFrame:
    return frame.where(F.col(column).between(F.lit(w.evaluation_start), F.lit(w.evaluation_end)))


def role_counts(frame: DataFrame, windows: list[SplitWindow]) -> DataFrame:
    """Rows per window and role. Rows are counted per date first, so only dates are copied per window."""
    by_date = frame.groupBy("CreateDate").agg(rows().alias("n"))
    copies = by_date.select("n", F.explode(F.array(*[
        F.struct(F.lit(w.name).alias("split_name"), role_in(w).alias("role")) for w in windows])).alias("_r"))
    return (copies.select("n", "_r.*").where("role is not null")
            .groupBy("split_name", "role").agg(F.sum("n").alias("rows")))


def _per_ride(frame: DataFrame, windows: list[SplitWindow], group: list[str]) -> DataFrame:
    """Rides with, per window, the rows on each side. One shuffle; partial sums first."""
    date_col = F.col("CreateDate")
    sides = []
    for w in windows:
        sides += [count_if(date_col.between(F.lit(w.train_start), F.lit(w.train_end))).alias(f"t{w.number}"),
                  count_if(date_col.between(F.lit(w.evaluation_start), F.lit(w.evaluation_end))).alias(f"e{w.number}")]
    return frame.groupBy(*group, "RideID").agg(*sides)


def _dates_by_side(frame: DataFrame, windows: list[SplitWindow], group: list[str]) -> DataFrame:
    """Per group and window: dates and timestamp limits on each side, from a per-date aggregate."""
    by_date = frame.groupBy(*group, "CreateDate").agg(F.min("Create").alias("lo"), F.max("Create").alias("hi"))
    copies = by_date.select(*group, "CreateDate", "lo", "hi", F.explode(F.array(*[
        F.struct(F.lit(w.number).alias("number"), role_in(w).alias("role")) for w in windows])).alias("_r"))
    t, e = F.col("_r.role") == "train", F.col("_r.role") == "eval"
    return copies.groupBy(*group, F.col("_r.number").alias("number")).agg(
        count_if(t).alias("train_days"), count_if(e).alias("evaluation_days"),
        F.min(F.when(t, F.col("CreateDate"))).alias("train_min_date"),
        F.max(F.when(t, F.col("CreateDate"))).alias("train_max_date"),
        F.min(F.when(e, F.col("CreateDate"))).alias("evaluation_min_date"),
        F.max(F.when(e, F.col("CreateDate"))).alias("evaluation_max_date"),
        F.max(F.when(t, F.col("hi"))).alias("train_max_ts"), F.min(F.when(e, F.col("lo"))).alias("evaluation_min_ts"))


def split_summary(frame: DataFrame, windows: list[SplitWindow], categories: list | None = None) -> DataFrame:
    """One row per window (and category): days, gap, rows, rides and rides on both sides."""
    group = [] if categories is None else ["CategoryID"]
    source = frame if categories is None else frame.where(F.col("CategoryID").isin(list(categories)))
    per_ride = _per_ride(source, windows, group)
    lines = []
    for w in windows:
        t, e = F.col(f"t{w.number}"), F.col(f"e{w.number}")
        gap = 0 if w.gap_start is None else (w.gap_end - w.gap_start).days + 1
        lines.append(F.struct(
            F.lit(w.number).alias("number"), F.lit(w.name).alias("split_name"), F.lit(w.split_type).alias("split_type"),
            F.lit(w.train_start).alias("train_start"), F.lit(w.train_end).alias("train_end"),
            F.lit(w.gap_start).cast("date").alias("gap_start"), F.lit(w.gap_end).cast("date").alias("gap_end"),
            F.lit(w.evaluation_start).alias("evaluation_start"), F.lit(w.evaluation_end).alias("evaluation_end"),
            F.lit(gap).cast("bigint").alias("gap_days"),
            F.coalesce(F.sum(t), F.lit(0)).alias("train_rows"), F.coalesce(F.sum(e), F.lit(0)).alias("evaluation_rows"),
            count_if(t > 0).alias("train_unique_rides"), count_if(e > 0).alias("evaluation_unique_rides"),
            count_if((t > 0) & (e > 0)).alias("ride_overlap")))
    counts = per_ride.groupBy(*group).agg(F.array(*lines).alias("_a")).select(*group, F.inline("_a"))
    return counts.join(_dates_by_side(source, windows, group), [*group, "number"], "left")


SUMMARY_COLUMNS = [
    "split_name", "split_type", "train_start", "train_end", "gap_start", "gap_end", "evaluation_start",
    "evaluation_end", "train_days", "gap_days", "evaluation_days", "train_rows", "evaluation_rows",
    "train_unique_rides", "evaluation_unique_rides", "ride_overlap"]


def fold_checks(summary: DataFrame) -> DataFrame:
    """Order, gap and overlap rules per window. A row is in both sides only if the sides overlap in time."""
    no = F.lit(False)
    order = F.coalesce(F.col("train_max_date") < F.col("evaluation_min_date"), no)
    stamps = F.coalesce(F.col("train_max_ts") < F.col("evaluation_min_ts"), no)
    gap = F.col("gap_start").isNull() | F.coalesce(
        (F.col("gap_start") > F.col("train_max_date")) & (F.col("evaluation_min_date") > F.col("gap_end")), no)
    disjoint = (F.col("train_end") < F.col("evaluation_start")) | (F.col("evaluation_end") < F.col("train_start"))
    index_overlap = F.when(disjoint, F.lit(0)).otherwise(F.least("train_rows", "evaluation_rows")).cast("bigint")
    out = summary.withColumns({"index_overlap": index_overlap, "temporal_order_ok": order,
                               "timestamp_order_ok": stamps, "gap_order_ok": gap})
    valid = order & stamps & gap & (F.col("index_overlap") == 0) & (F.col("ride_overlap") == 0)
    return out.withColumn("fold_valid", valid)


def guarded(summary: DataFrame) -> DataFrame:
    """The summary itself, failing while it is computed when a side is empty or a ride is on both sides."""
    broken = F.raise_error(F.concat(F.lit("fold cannot be used: "), F.col("split_name"))).cast("bigint")
    usable = (F.col("train_rows") > 0) & (F.col("evaluation_rows") > 0) & (F.col("ride_overlap") == 0)
    return summary.withColumn("ride_overlap", F.when(usable, F.col("ride_overlap")).otherwise(broken))


def require_valid_folds(checks: DataFrame) -> DataFrame:
    """The checks themselves, failing while they are computed at the first fold that breaks a rule."""
    return checks.withColumn("fold_valid", F.when(F.col("fold_valid"), True).otherwise(broken("invalid fold:", "split_name").cast("boolean")))
