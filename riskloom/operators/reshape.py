"""Column renames, dense ids and the reshapes (stack / unpivot / pivot / full outer)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.rules import PANEL_MONTH_LABELS, PANEL_MONTHS
from riskloom.sources.schemas import (CREDIT_POSITIONAL_NAMES, INDICATOR_COLUMNS,
                                      MARKETING_RENAMES, RECENT_VALUES)


# --------------------------------------------------------------------------
# Renames (driver-side work on column *names* only)
# --------------------------------------------------------------------------

def normalise_name(name: str) -> str:
    """'.' and ' ' -> '_', lower case."""
    return name.replace(".", "_").replace(" ", "_").lower()


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns of ``mapping`` that exist; absent ones are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def rename_credit_positional(df: DataFrame, strict: bool = True) -> DataFrame:
    """X1..X23, Y -> business names. With ``strict`` every source name must exist."""
    if strict:
        missing = [k for k in CREDIT_POSITIONAL_NAMES if k not in df.columns]
        if missing:
            raise ValueError(f"positional credit columns missing: {missing}")
    return rename_present(df, CREDIT_POSITIONAL_NAMES)


def rename_marketing(df: DataFrame) -> DataFrame:
    """Normalise names, then apply the conditional marketing renames."""
    return rename_present(normalise_names(df), MARKETING_RENAMES)


# --------------------------------------------------------------------------
# Dense surrogate ids
# --------------------------------------------------------------------------

SORT_BYTES = 256 << 20


def add_dense_id(df: DataFrame, order_by: Sequence[str], id_col: str = "id",
                 num_partitions: int | None = None) -> DataFrame:
    """Dense ids 1..n following ``order_by``; ties are broken by a hash of the row.

    Two passes: the frame is range-partitioned and sorted within partitions,
    stamped with (partition, position) and written once as a table in the
    shared checkpoint folder, so both passes read the same stamps (range
    sampling could otherwise differ between two evaluations) and a lost
    executor does not change them. Pass one counts rows per partition (one
    row per partition, broadcast); pass two adds the partition's offset to
    the position. No single-task global window.
    """
    from riskloom.session import estimated_bytes, materialize

    spark = df.sparkSession
    # partitions by size: one sort task of up to ``SORT_BYTES``, at least one a slot
    n = num_partitions or max(spark.sparkContext.defaultParallelism, math.ceil((estimated_bytes(df) or 0) / SORT_BYTES))
    part = materialize(stamp_positions(df, order_by, n), "dense-id")
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # Offsets over at most ``n`` rows (one per partition).
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
         ).alias("_off"))
    out = part.join(F.broadcast(offsets), "_pid")
    return out.select((F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1).alias(id_col),
                      *[c for c in df.columns if c != id_col])  # drops _pid, _pos, _tb


def stamp_positions(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """Range-partition on ``order_by`` (+ row-hash tiebreak), sort, stamp (partition, position).

    Ties in ``order_by`` have no defined order; a hash of the whole row breaks
    them deterministically and lets range partitioning split a hot value
    (say a third of all rows on one key) over many partitions.
    """
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.withColumn("_tb", tiebreak)
            .repartitionByRange(n, *order_by, "_tb")
            .sortWithinPartitions(*order_by, "_tb")
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)))


# --------------------------------------------------------------------------
# Month panel -> long
# --------------------------------------------------------------------------

def months_long(df: DataFrame, keep: Sequence[str],
                fields: Mapping[str, str] | None = None) -> DataFrame:
    """Six month columns -> six rows per input row in one scan (``stack``).

    ``fields`` maps each output column to the prefix of its six month
    columns (default: pay_status <- pay_status_*, balance <- bill_amt_*).
    Output: keep..., month_num (1=Apr .. 6=Sep), obs_month, fields...
    Rows whose month values are NULL are kept, as a UNION ALL would keep them.
    """
    fields = dict(fields or {"pay_status": "pay_status_", "balance": "bill_amt_"})
    parts = []
    for i, (m, label) in enumerate(zip(PANEL_MONTHS, PANEL_MONTH_LABELS), start=1):
        cols = ", ".join(f"`{prefix}{m}`" for prefix in fields.values())
        parts.append(f"{i}, '{label}', {cols}")
    names = ", ".join(["month_num", "obs_month", *fields])
    stack = f"stack({len(parts)}, {', '.join(parts)}) AS ({names})"
    return df.selectExpr(*[f"`{c}`" for c in keep], stack)


# --------------------------------------------------------------------------
# Indicator series
# --------------------------------------------------------------------------

def unpivot_years(wide: DataFrame, id_cols: Sequence[str], value_name: str = "value") -> DataFrame:
    """One row per series and one column per year -> (ids..., year int, value).

    ``unpivot`` keeps NULL cells (an Expand over one scan).
    """
    year_cols = [c for c in wide.columns if c not in id_cols]
    long = wide.unpivot(list(id_cols), year_cols, "year", value_name)
    return long.withColumn("year", F.col("year").cast("int"))


def recent_values(long: DataFrame, n: int = RECENT_VALUES,
                  keys: Sequence[str] = ("country_code", "indicator")) -> DataFrame:
    """The rows of the ``n`` most recent years per series; years with an empty value count.

    A row number under a limit: Spark keeps the n newest rows a series in
    every task before the shuffle (``WindowGroupLimit``), so a series with a
    third of all rows sends n rows a task.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("year").desc())
    return long.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def recent_values_wide(panel: DataFrame, n: int = RECENT_VALUES,
                       indicators: Sequence[str] = INDICATOR_COLUMNS) -> DataFrame:
    """Wide-panel form of ``recent_values`` + ``pivot_indicators``.

    A panel row is one year of every series of its country, so the n newest
    rows of a country are the n newest years of each; rows left without any
    value are dropped. One window over the country, no unpivot/pivot round trip.
    """
    newest = recent_values(panel.select("year", "country_code", *indicators), n, ("country_code",))
    return newest.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in indicators]))


def pivot_indicators(long: DataFrame, indicators: Sequence[str] = INDICATOR_COLUMNS) -> DataFrame:
    """Long series -> wide panel, one column per expected indicator.

    Explicit pivot values: no extra job to find them, and an indicator with
    no series at all comes out as a NULL double column.
    """
    return (long.groupBy("country_code", "year")
            .pivot("indicator", list(indicators)).agg(F.max("value"))
            .select("year", "country_code", *indicators))


def full_outer_series(long: DataFrame, indicators: Sequence[str] = INDICATOR_COLUMNS) -> DataFrame:
    """The same wide panel as a chain of FULL OUTER joins on (country, year)."""
    series = [long.filter(F.col("indicator") == ind)
              .select("country_code", "year", F.col("value").alias(ind)) for ind in indicators]
    merged = reduce(lambda a, b: a.join(b, ["country_code", "year"], "full"), series)
    return merged.select("year", "country_code", *indicators)
