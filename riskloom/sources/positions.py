"""Row positions of landed files, and two files glued row by row.

A row's position is the number of rows in the files before its own, in
natural order of the file names, plus its place in the file. Parquet states
the place itself (``_metadata.row_index``); the rows are read where they are,
without a sort and without a window over them. The offsets of the files come
from one count per file, which Parquet answers from its footers.

Text formats have no row index: their rows are stamped once with file, split
and order inside the split, written to the shared checkpoint folder, and
positions follow from one count per split.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: files (or splits) whose offsets are broadcast; beyond it their join is left to Spark
MAX_BROADCAST_FILES = 200_000


class UnequalRows(ValueError):
    """Two sides of a glue that do not have the same number of rows."""

    def __init__(self, left: int, right: int) -> None:
        super().__init__(f"cannot glue by row position: {left} rows on one side, {right} on the other")
        self.left, self.right = left, right


def natural(path: str) -> list:
    """Sort key of a file name: runs of digits compare as numbers (part-9 before part-10)."""
    return [(int(x), "") if x.isdigit() else (-1, x) for x in re.split(r"(\d+)", path) if x]


def _offsets(df: DataFrame, stats, names: list[str]) -> tuple[DataFrame, int]:
    """A frame of (names..., _offset) for (file, [split,] rows) records in their order, and the total of rows."""
    rows, total = [], 0
    for r in sorted(stats, key=lambda r: (natural(r["_file"]), r["_split"])):
        rows.append((r["_file"], r["_split"], r["_base"], total))
        total += r["_rows"]
    side = df.sparkSession.createDataFrame(rows, "_file string, _split bigint, _base bigint, _offset bigint").select(*names, "_offset")
    return (F.broadcast(side) if len(rows) <= MAX_BROADCAST_FILES else side), total


def parquet_positions(df: DataFrame, name: str = "position", *extra: str) -> tuple[DataFrame, int]:
    """(``df`` with a column of positions 0..n-1, n) for a frame read from Parquet files; ``extra`` may be "_file"."""
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    stats = df.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_rows")).select(
        "_file", F.lit(0).alias("_split"), F.lit(0).alias("_base"), "_rows").collect()
    side, total = _offsets(df, stats, ["_file"])
    out = df.select("*", file.alias("_file"), row.alias("_row")).join(side, "_file")
    return out.select(*df.columns, *extra, (F.col("_offset") + F.col("_row")).alias(name)), total


def stamped_positions(df: DataFrame, name: str = "position", *extra: str) -> tuple[DataFrame, int]:
    """The same for a frame read from text files: rows are stamped and written once."""
    from riskloom.session import materialize
    stamp = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                      F.monotonically_increasing_id().alias("_at"))
    part = materialize(stamp, "stamped")
    stats = part.groupBy("_file", "_split").agg(F.min("_at").alias("_base"), F.count(F.lit(1)).alias("_rows")).collect()
    side, total = _offsets(df, stats, ["_file", "_split", "_base"])
    out = part.join(side, ["_file", "_split"])
    return out.select(*df.columns, *extra, (F.col("_offset") + F.col("_at") - F.col("_base")).alias(name)), total


def positions(df: DataFrame, fmt: str, name: str = "position", *extra: str) -> tuple[DataFrame, int]:
    return (parquet_positions if fmt == "parquet" else stamped_positions)(df, name, *extra)


def glue(left: DataFrame, right: DataFrame, left_fmt: str = "parquet", right_fmt: str = "parquet",
         name: str = "position") -> DataFrame:
    """Columns of both sides put together row by row, with the position; raises ``UnequalRows`` on unlike counts."""
    a, n = positions(left, left_fmt, name)
    b, m = positions(right, right_fmt, name)
    if n != m:
        raise UnequalRows(n, m)
    return a.join(b, name)
