"""Row numbers that scale: within groups, and globally (dense ids).

``row_number() OVER (PARTITION BY g ORDER BY o)`` hash-partitions on ``g``,
so one hot group (a user holding a third of the log) lands in one task, and
``row_number() OVER (ORDER BY o)`` runs in a single partition.  Numbers within
groups are built from cells of a group instead (``sequence_within``), and the
global order of dense ids is numbered from a global sort:

1. range-partition on o and sort inside partitions — the sampled range
   bounds split any order across many tasks;
2. in the same tasks, record the partition id and the position inside the
   partition (``monotonically_increasing_id`` low bits) and write the frame
   as Parquet under the reliable checkpoint directory: the layout is fixed
   (re-sampling on recompute would move the bounds), lineage is cut, and a
   lost executor re-reads the table instead of re-running the sort;
3. per-partition row counts (one number per partition, bounded by the
   partition count) give each partition's offset and so a global rank;
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_recs.session import scratch_path

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in the low 33 bits


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def global_rank(df: DataFrame, order: Sequence[str | Column], out: str = "_grank",
                num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based global rank in ``order`` (ties broken arbitrarily but
    consistently), without a single-partition exchange."""
    spark = df.sparkSession
    ocols = _as_cols(order)
    # Without an explicit count AQE may coalesce adjacent ranges; they stay
    # in order, so partition id + position still follow the global order.
    # Partition id and position are taken in the task that sorted the range
    # and stored with the rows, so the ranks survive any later re-planning
    # or file-to-partition mapping on read-back.
    ranged = df.repartitionByRange(num_partitions, *ocols) if num_partitions else df.repartitionByRange(*ocols)
    ranked = (ranged.sortWithinPartitions(*ocols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    path = scratch_path(spark, "ranked")
    ranked.write.mode("errorifexists").parquet(path)
    stored = spark.read.schema(ranked.schema).parquet(path)
    # Row count of each range partition: one number per partition, the same
    # metadata RDD.zipWithIndex gathers.  Their running sums are joined on the
    # partition id: one row per partition, so they are broadcast, and no
    # single-partition step is needed.
    sizes = sorted(stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, acc = [], 0
    for pid, n in sizes:
        offsets.append((pid, acc))
        acc += n
    off = F.broadcast(spark.createDataFrame(offsets, "_pid int, _off long"))
    return (stored.join(off, "_pid").withColumn(out, F.col("_off") + F.col("_pos") + F.lit(1))
                  .drop("_pid", "_pos", "_off"))


def sequence_within(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], cell: Column,
                    out: str = "row_number", count_out: str | None = "count") -> DataFrame:
    """``row_number() over (partition by group order by order)`` (1-based)
    plus, optionally, the group's row count, robust to hot groups.

    ``cell`` is a coarse step of the order (equal or rising with it, such as
    the day of a time stamp).  Rows are shuffled and numbered by (group,
    cell), so a hot group is spread over as many tasks as it has cells; the
    rows of a group's earlier cells, summed over one row per cell, are then
    added.  A cell's row is its first listen, with the cell's count, so that
    both sides of the join come from one shuffle (the exchange is reused) and
    the input is read once.  Rows whose group keys are null are numbered as
    one group.
    """
    spread = df.withColumn("_cell", cell)
    keys = [*group, "_cell"]
    inside = Window.partitionBy(*keys).orderBy(*_as_cols(order))
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = spread.select("*", F.row_number().over(inside).alias("_inside"), F.count(F.lit(1)).over(whole).alias("_rows"))
    cells = numbered.filter(F.col("_inside") == 1).select(*keys, "_rows")
    earlier = Window.partitionBy(*group).orderBy(F.col("_cell").asc_nulls_first())
    cells = (cells.withColumn("_before", F.sum("_rows").over(earlier) - F.col("_rows"))
                  .withColumn("_total", F.sum("_rows").over(Window.partitionBy(*group)))
                  .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before", "_total"))
    joined = numbered.join(cells, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    res = joined.withColumn(out, F.col("_inside") + F.col("_before"))
    if count_out:
        res = res.withColumn(count_out, F.col("_total"))
    return res.drop("_inside", "_rows", "_cell", "_before", "_total", *[f"_k{i}" for i in range(len(keys))])


MAX_CUTS = 100_000  # cut points that are broadcast


def with_quantile_cells(df: DataFrame, group: Sequence[str], coarse: str, fine: Sequence[str], out: str = "_cell",
                        cell_rows: int = 1_000_000, sample_rows: int = 400_000, seed: int = 7) -> DataFrame:
    """``df`` with a cell for ``sequence_within`` that splits hot cells of the
    ``coarse`` column (one user's listens of one day) by sampled quantiles of
    the ``fine`` order inside them.

    The coarse cells are counted.  Those above ``cell_rows`` get cut points from
    a sample of their rows (about ``sample_rows`` in all); a row's part is the
    number of cut points at or below it, so cells rise with (coarse, fine)
    whatever the sample, which only sets how even they are.  There are at most
    ``MAX_CUTS`` cut points (cells grow beyond that), which are broadcast.  Rows
    equal in every fine column stay in one cell.
    """
    keys = [*group, coarse]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    cell_rows = max(cell_rows, -(-2 * df.count() // MAX_CUTS))
    hot = counts.filter(F.col("_n") > cell_rows).select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "_n")
    same = [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)]
    total = hot.agg(F.sum("_n")).first()[0]
    if not total:
        return df.withColumn(out, F.struct(F.col(coarse).alias("coarse"), F.lit(0).alias("part")))
    key = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fine)])
    drawn = (df.filter(F.pmod(F.xxhash64(*keys, *fine, F.lit(seed)), F.lit(max(1, total // sample_rows))) == 0)
               .join(F.broadcast(hot), same).select(*[f"_h{i}" for i in range(len(keys))], "_n", key.alias("_k")))
    drawn = (drawn.groupBy(*[f"_h{i}" for i in range(len(keys))], "_n").agg(F.array_sort(F.collect_list("_k")).alias("_s"))
                  .withColumn("_parts", F.ceil(F.col("_n") / F.lit(cell_rows)).cast("int")))
    cut = lambda i: F.col("_s")[F.floor(i * F.size("_s") / F.col("_parts")).cast("int")]
    cuts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("_parts") - 1), cut))
    cuts = drawn.select(*[f"_h{i}" for i in range(len(keys))], cuts.alias("_cuts"))
    part = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= key)), F.lit(0))
    cell = F.struct(F.col(coarse).alias("coarse"), F.when(F.col("_cuts").isNull(), 0).otherwise(part).alias("part"))
    return df.join(F.broadcast(cuts), same, "left").select(*df.columns, cell.alias(out))


def dense_ids(df: DataFrame, key: str, out: str, start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by key)`` over the distinct keys: a dense
    id map (out, key) numbered from ``start``."""
    distinct = df.select(key).distinct()
    ranked = global_rank(distinct, [key], "_grank", num_partitions)
    return ranked.select((F.col("_grank") + F.lit(start - 1)).alias(out), key)
