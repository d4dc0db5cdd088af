"""Running totals per key over strictly earlier rows, safe for hot keys.

Rows are split by (key, nested buckets): bucket totals are pre-aggregated, summed over the earlier buckets of the key,
and added to the running total inside the row's own bucket. There is one way at every size.
"""
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

EARLIER = (Window.unboundedPreceding, -1)


def hour_bucket(ts: str) -> Column:
    """Hours since 1970: monotone in the timestamp; rows without a time come first."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.coalesce(F.timestamp_diff("HOUR", epoch, F.col(ts).cast("timestamp_ntz")), F.lit(-2**62))


def time_levels(ts: str, tie: str, block: int = 65_536) -> list[Column]:
    """Nested levels for rows ordered by (ts, tie): hour, minute, second, then the time with a block of the whole-number
    tie-breaker, so that rows of one moment can be split too."""
    at = F.col(ts).cast("timestamp_ntz")
    return [hour_bucket(ts), F.minute(at), F.second(at),
            F.struct(F.col(ts).alias("at"), F.floor(F.col(tie) / block).alias("block"))]


def running_before(df: DataFrame, keys: list[str], order: list, sums: dict[str, Column],
                   levels: list[Column]) -> DataFrame:
    """Add, per name, the sum of its expression over earlier rows of the same keys (0 when none).

    `order` must be total within the keys. `levels` are nested buckets, coarse to fine, each monotone in the order
    inside the one before. Rows without a key have no order: they fail the run. Fractions are summed as decimals of
    ten places, so no sum depends on the order of its terms.
    """
    zero = F.lit(0)
    buckets = [f"_bucket_{i}" for i in range(len(levels))]
    known = [F.coalesce(F.col(k), F.raise_error(F.lit(f"null key {k}")).cast(df.schema[k].dataType)).alias(k)
             for k in keys]
    rest = [c for c in df.columns if c not in keys]
    rows = df.select(*known, *rest, *[e.alias(b) for e, b in zip(levels, buckets)],
                     *[e.alias(f"_v_{n}") for n, e in sums.items()])
    floats = [n for n in sums if rows.schema[f"_v_{n}"].dataType.simpleString() in ("double", "float")]
    rows = rows.withColumns({f"_v_{n}": F.col(f"_v_{n}").cast("decimal(28,10)") for n in floats})
    offsets = _offsets(rows, keys, buckets, list(sums))
    inside = Window.partitionBy(*keys, *buckets).orderBy(*order).rowsBetween(*EARLIER)
    local = rows.select("*", *[
        F.coalesce(F.sum(f"_v_{n}").over(inside), zero).alias(f"_l_{n}") for n in sums])
    whole = {n: F.col(f"_o_{n}") + F.col(f"_l_{n}") for n in sums}
    return local.join(offsets, [*keys, *buckets]).select(
        *df.columns, *[(e.cast("double") if n in floats else e).alias(n) for n, e in whole.items()])


def _offsets(rows: DataFrame, keys: list[str], buckets: list[str], names: list[str]) -> DataFrame:
    """Per bucket, the sums over all earlier buckets of the key. Totals are pre-aggregated level by level, so no
    window sees more than the buckets inside one bucket of the level above."""
    totals = rows.groupBy(*keys, *buckets).agg(*[F.sum(f"_v_{n}").alias(f"_v_{n}") for n in names])
    outer, last = buckets[:-1], buckets[-1]
    before = Window.partitionBy(*keys, *outer).orderBy(last).rowsBetween(*EARLIER)
    here = totals.select(*keys, *buckets, *[
        F.coalesce(F.sum(f"_v_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names])
    if not outer:
        return here
    above = _offsets(totals, keys, outer, names).withColumnsRenamed({f"_o_{n}": f"_a_{n}" for n in names})
    return here.join(above, [*keys, *outer]).select(
        *keys, *buckets, *[(F.col(f"_o_{n}") + F.col(f"_a_{n}")).alias(f"_o_{n}") for n in names])


#: Places of fractions in exact sums, as a factor.
PLACES = 10**10


def prefix_scan(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """The same sums by one range shuffle on (keys, order): each task adds up its own range and the last row of a range says
    what its key holds there, so a key over many ranges is continued by a table of one row per range.

    `order` must be total within the keys. A key of any size is split by the ranges themselves. Rows without a key fail the
    run. Fractions are added as whole units and ten places, so no sum depends on the order of its terms.
    """
    known = [F.coalesce(F.col(k), F.raise_error(F.lit(f"null key {k}")).cast(df.schema[k].dataType)).alias(k) for k in keys]
    rest = [c for c in df.columns if c not in keys]
    rows = df.select(*known, *rest, *[e.alias(f"_v_{n}") for n, e in sums.items()])
    floats = [n for n in sums if rows.schema[f"_v_{n}"].dataType.typeName() not in ("byte", "short", "integer", "long")]
    parts = []  # whole numbers, each the sum of one column
    for n in sums:
        v = F.coalesce(F.col(f"_v_{n}"), F.lit(0))
        parts.append(F.floor(v).cast("long").alias(f"_a_{n}"))
        if n in floats:
            parts.append(F.round((v - F.floor(v)) * PLACES).cast("long").alias(f"_b_{n}"))
    whole = rows.select(*df.columns, *parts)
    added = [c for c in whole.columns if c not in df.columns]
    ranged = whole.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    fields = T.StructType([*ranged.schema.fields, *[T.StructField(f"_p{c}", T.LongType()) for c in added],
                           T.StructField("_range", T.IntegerType()), T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType())])

    def run(batches):
        from pyspark import TaskContext
        number, key, first_key, total, held = TaskContext.get().partitionId(), None, None, [0] * len(added), None
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column(k) for k in keys]
            same = np.ones(b.num_rows, bool)
            for column in now:
                same[1:] &= np.asarray(pc.equal(column[1:], column[:-1]))
            tuple_at = lambda i, c=now: tuple(x[i].as_py() for x in c)
            same[0] = tuple_at(0) == key
            first_key = tuple_at(0) if first_key is None else first_key
            starts = np.flatnonzero(~same)
            run_of = np.cumsum(~same)  # 0: goes on from the batch before
            out = []
            for k, c in enumerate(added):
                values = b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                until = np.cumsum(values) - values
                base = np.concatenate([[-total[k]], until[starts]])[run_of]
                out.append(until - base)
                total[k] = int(out[-1][-1] + values[-1])
            in_first = np.zeros(b.num_rows, bool)
            if key is None or key == first_key:
                head = starts[1] if key is None and len(starts) > 1 else starts[0] if key is not None and len(starts) else b.num_rows
                in_first[:head] = True
            key = tuple_at(b.num_rows - 1)
            done = pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(x) for x in out], pa.array(np.full(b.num_rows, number, np.int32)), pa.array(in_first),
                 pa.array(np.zeros(b.num_rows, bool))], names=fields.names)
            if held is not None:
                yield held
            held = done
        if held is not None:
            last = np.zeros(held.num_rows, bool)
            last[-1] = True
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.array(last)], names=fields.names)

    scanned = materialize(ranged.mapInArrow(run, fields), "scanned")
    ends = scanned.where("_last").select(*keys, "_range", *[(F.col(f"_p{c}") + F.col(c)).alias(c) for c in added])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    carried = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_from"),
                          F.lead("_range").over(Window.orderBy("_range")).alias("_to"), *[F.sum(c).over(earlier).alias(f"_c{c}") for c in added])
    # one row per range: the range after it goes on with what its last key holds
    match = (F.col("_range") == F.col("_to")) & F.col("_first")
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_k{i}"))
    joined = scanned.join(F.broadcast(carried), match, "left")
    total = {c: F.col(f"_p{c}") + F.coalesce(F.col(f"_c{c}"), F.lit(0)) for c in added}
    exact = {n: (total[f"_a_{n}"].cast("decimal(28,10)") + (total[f"_b_{n}"].cast("decimal(28,0)") / F.lit(PLACES).cast("decimal(20,0)"))).cast("double")
             if n in floats else total[f"_a_{n}"] for n in sums}
    return joined.select(*df.columns, *[e.alias(n) for n, e in exact.items()])


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the first row per key. The rank filter is pushed below the shuffle, so each task sends at
    most one row per key and a hot key costs no more than any other."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
