"""Building blocks that keep hot keys, large groups and growing small sides from hurting a job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.session import stage

# A group of this many narrow rows sorts comfortably inside one task.
ROWS_PER_TASK = 1_000_000
# Far below Spark's own 8 GB limit, so that a broadcast copy fits next to the work on every executor.
BROADCAST_BYTES = 64 << 20


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that sorts first by ``order`` (ascending, nulls first).

    An aggregate rather than ``row_number() = 1``: map tasks keep one row per key, so even a key that
    holds most of the table sends only one row per task over the network.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    out: str = "rank",
    spread: str | None = None,
    buckets: int = 64,
) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1.

    Up to the planner's threshold for ``k``, ``row_number() <= k`` becomes a group limit that already runs in the map
    tasks, so a hot key sends ``k`` rows per task. Beyond it, a first round per (key, hash bucket of ``spread``) bounds
    what the last round reads to ``buckets * k`` rows.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if spread is not None and k > limit:
        salt = F.pmod(F.xxhash64(spread), F.lit(buckets))
        salted = df.withColumn("_salt", salt)
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n", "_salt")
    last = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(last)).where(F.col(out) <= k)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the key (0 for the first), whatever the size of a key.

    The rows are range-partitioned on (keys, order) and summed inside each range; what the same key has in earlier
    ranges is added. The ranges are staged because both steps must see the same ones. ``order`` should be unique
    inside a key, else equal rows stay together in one range. Columns come back as in ``df``, plus ``out`` (BIGINT).
    """
    by_range = df.withColumn("_value", value.cast("bigint")).repartitionByRange(*[F.col(c) for c in keys], *order)
    ranged = stage(by_range.withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy("_range", *keys).agg(F.sum("_value").alias("_sum"))  # at most one row per range and key in it
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        F.col("_range").alias("_range_r"),
        *[F.col(c).alias(f"_key_{c}") for c in keys],
        F.sum("_sum").over(earlier).alias("_before"),
    ).where(F.col("_before").isNotNull())
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    match = F.col("_range") == F.col("_range_r")
    for c in keys:
        match = match & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    total = F.col("_local") + F.coalesce("_before", F.lit(0))
    return local.join(shifts, match, "left").select(*df.columns, total.alias(out))


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows, staged in ranges of (keys, order); ``_range`` numbers them. What ``running`` works on."""
    ranged = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return stage(ranged.withColumn("_range", F.spark_partition_id()))


def running(
    ranged: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    earlier: dict[str, Column] | None = None,
) -> DataFrame:
    """A prefix scan along each key, however long it is: rows of ``in_ranges`` with further columns.

    ``sums`` add up to and with the row, ``lasts`` are the last value up to and with the row that is not null, ``earlier``
    the last one before the row. Every range is scanned by itself; what a key has in earlier ranges is summed up from one
    row per range and key, when this is called. ``keys`` may be more than the rows were ranged by, as long as they ascend with
    ``order``; then only the first key of a range can have earlier ones, so what is carried is a row per range and is broadcast.
    The rows themselves are not staged: scans of scans run in one pass, and readers of few columns carry few.
    """
    sums, lasts, earlier = sums or {}, lasts or {}, earlier or {}
    values = {**sums, **lasts, **earlier}
    rows = ranged.withColumns({f"_v_{n}": v for n, v in values.items()})
    at = F.struct(*order)
    per_range = rows.groupBy("_range", *keys).agg(
        *[F.sum(f"_v_{n}").alias(n) for n in sums],
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(n) for n in (*lasts, *earlier)],
    )
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_range.select(
        F.col("_range").alias("_range_r"),
        *[F.col(c).alias(f"_key_{c}") for c in keys],
        *[F.sum(n).over(before).alias(f"_b_{n}") for n in sums],
        *[F.last(n, ignorenulls=True).over(before).alias(f"_b_{n}") for n in (*lasts, *earlier)],
    )
    carried = stage(shifts.where(reduce(or_, [F.col(f"_b_{n}").isNotNull() for n in values])))
    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    so_far, until = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns(
        {f"_l_{n}": F.sum(f"_v_{n}").over(so_far) for n in sums}
        | {f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(so_far) for n in lasts}
        | {f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(until) for n in earlier}
    )
    match = F.col("_range") == F.col("_range_r")
    for c in keys:
        match = match & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    joined = local.join(F.broadcast(carried), match, "left")
    zero = F.lit(0)
    return joined.select(
        *ranged.columns,
        *[(F.coalesce(f"_l_{n}", zero) + F.coalesce(f"_b_{n}", zero)).alias(n) for n in sums],
        *[F.coalesce(f"_l_{n}", f"_b_{n}").alias(n) for n in (*lasts, *earlier)],
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, rows_per_key: int | None = None
) -> DataFrame:
    """``row_number()`` from 1 per key (BIGINT).

    ``rows_per_key`` is a bound known by construction; up to ``ROWS_PER_TASK`` a plain window does. Without one no
    key is gathered in one task (see ``running_sum``).
    """
    if rows_per_key is not None and rows_per_key <= ROWS_PER_TASK:
        whole = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.row_number().over(whole).cast("bigint"))
    counted = running_sum(df, keys, order, F.lit(1), "_earlier")
    return counted.withColumn(out, F.col("_earlier") + 1).drop("_earlier")


def _bytes_per_row(df: DataFrame) -> Column:
    """Sum over the rows; maps, structs and arrays of anything but numbers count as long as their JSON text."""
    total = F.lit(16)
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            size = F.lit(8) * F.size(column)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(column)))
        else:
            size = F.lit(8)
        total = total + F.greatest(F.coalesce(size, F.lit(0)), F.lit(0))
    return F.sum(total.cast("bigint"))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a side that is expected to be small; one aggregate job, nothing is collected."""
    rows, size = df.agg(F.count("*"), _bytes_per_row(df)).first()
    return rows, size or 0


def small_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: str | None = None,
    limit: int = BROADCAST_BYTES,
    buckets: int = 64,
    size: int | None = None,
) -> DataFrame:
    """Join a large side to one that is usually small.

    The small side is measured (unless the caller already knows a bound, ``size``): up to ``limit`` bytes it is broadcast and the large side stays where it is.
    Beyond that both sides shuffle, the hot keys of the large side spread over ``buckets`` salts.
    """
    if (measure(small)[1] if size is None else size) <= limit:
        return big.join(F.broadcast(small), list(on), how)
    if spread is None:
        return big.join(small, list(on), how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
