"""Readers for landed raw files (parquet / csv / json): columns by name, types declared here.

The pipeline's inputs are files already landed in shared storage; nothing
is fetched over the network here. A file's columns are found by the names in
the file (CSV header, Parquet footer, JSON keys), so their order does not
matter, and a name that is absent raises with the list of absent ones. Values
are then cast to the declared types; a cell that does not fit its type becomes
NULL and is counted by ``bad_values``. No schema is inferred from values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DoubleType, IntegerType, IntegralType, StringType, StructField,
                               StructType)

from riskloom.operators import reshape
from riskloom.sources import positions
from riskloom.sources.schemas import (CREDIT_POSITIONAL_NAMES, INDICATORS, MARKETING_RENAMES,
                                      RAW_CREDIT_COLUMNS, RAW_CREDIT_SCHEMA, RAW_MARKETING_COLUMNS,
                                      RAW_MARKETING_SCHEMA)


class MissingColumns(ValueError):
    """Required columns that a landed file does not have."""

    def __init__(self, path: str, missing: Sequence[str]) -> None:
        super().__init__(f"{path}: columns missing in the file: {', '.join(missing)}")
        self.missing = list(missing)


def file_columns(spark: SparkSession, path: str, fmt: str, wanted: Sequence[str], sep: str = ",") -> DataFrame:
    """The file as it names its columns, untyped where the format has no types.

    CSV: every column of the header as text. Parquet: the columns of all footers.
    JSON has no header: the ``wanted`` names are read as text, and those that
    no record has are left out (one aggregate over the file).
    """
    if fmt == "csv":
        return spark.read.option("header", "true").option("sep", sep).csv(path)
    if fmt == "json":
        df = spark.read.schema(StructType([StructField(c, StringType()) for c in wanted])).json(path)
        seen = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(wanted)]).first()
        return df.select(*[F.col(f"`{c}`") for i, c in enumerate(wanted) if seen[f"c{i}"] or not seen["rows"]])
    reader = spark.read.format(fmt)
    # the columns of all files, not of whichever footer Spark happens to take; a file that lacks one reads as NULL
    return (reader.option("mergeSchema", "true") if fmt == "parquet" else reader).load(path)


def typed(c: Column, source: DataType, target: DataType) -> Column:
    """``c`` as ``target``, NULL where it does not fit; whole numbers written as 12.0 are whole numbers."""
    if source == target:
        return c
    if isinstance(target, IntegralType) and not isinstance(source, IntegralType):
        number = F.trim(c).try_cast("double") if isinstance(source, StringType) else c.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(target))
        # long texts of digits keep their exact value
        return F.coalesce(F.trim(c).try_cast(target), whole) if isinstance(source, StringType) else whole
    return c.try_cast(target)


def _select(df: DataFrame, path: str, schema: StructType, names: Mapping[str, str]) -> list[tuple[str, Column, Column]]:
    """[(name, source column, typed column)] by name; ``names`` maps table names to file names. Raises on absent ones."""
    missing = [names[f.name] for f in schema.fields if names[f.name] not in df.columns]
    if missing:
        raise MissingColumns(path, missing)
    out = []
    for f in schema.fields:
        c = F.col(f"`{names[f.name]}`")
        out.append((f.name, c, typed(c, df.schema[names[f.name]].dataType, f.dataType).alias(f.name)))
    return out


def _credit(spark, path, fmt, positional, with_id, sep=",", only=None):
    fields = [f for f in RAW_CREDIT_SCHEMA.fields if (with_id or f.name != "id") and (only is None or f.name in only)]
    schema = StructType(fields)
    back = {v: k for k, v in CREDIT_POSITIONAL_NAMES.items()} if positional else {}
    names = {f.name: back.get(f.name, f.name) for f in fields}
    df = file_columns(spark, path, fmt, list(names.values()), sep)
    return df, _select(df, path, schema, names)


def bad_values(df: DataFrame, columns: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """(column_name, bad_rows): cells with a value that does not fit the declared type. One pass."""
    counts = df.agg(*[F.count(F.when(raw.isNotNull() & (raw.cast("string") != "") & cast.isNull(), 1)).alias(f"n{i}")
                      for i, (_, raw, cast) in enumerate(columns)])
    pairs = ", ".join(f"'{name}', n{i}" for i, (name, _, _) in enumerate(columns))
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, bad_rows)")


def credit_bad_values(spark: SparkSession, path: str, fmt: str = "parquet", positional: bool = False,
                      with_id: bool = True, sep: str = ",") -> DataFrame:
    return bad_values(*_credit(spark, path, fmt, positional, with_id, sep))


def read_raw_credit(spark: SparkSession, path: str, fmt: str = "parquet",
                    positional: bool = False, order_by: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Credit records; ``positional`` files carry X1..X23, Y and are renamed. Every column must be in the file.

    A file without an ``id`` column gets dense ids 1..n, in ``order_by`` order
    where it is given, else in the order of the rows in the files.
    """
    if not order_by and "id" not in file_columns(spark, path, fmt, ["id"], sep).columns:
        df, cols = _credit(spark, path, fmt, positional, False, sep)
        return _numbered(df, [c for _, _, c in cols], fmt).select(*RAW_CREDIT_COLUMNS)
    df, cols = _credit(spark, path, fmt, positional, not order_by, sep)
    df = df.select(*[c for _, _, c in cols])
    if order_by:
        key = [CREDIT_POSITIONAL_NAMES.get(c, c) for c in order_by] if positional else list(order_by)
        extra = [c for c in key if c not in df.columns]
        if extra:
            raise ValueError(f"order_by columns not in the credit schema: {extra}")
        df = reshape.add_dense_id(df, key)
    return df.select(*RAW_CREDIT_COLUMNS)


def _numbered(df: DataFrame, columns: Sequence[Column], fmt: str) -> DataFrame:
    """The typed ``columns`` with ids 1..n in the order of the rows in the files (see ``positions``)."""
    placed, _ = positions.positions(df, fmt, "_position")
    return placed.select((F.col("_position") + 1).alias("id"), *columns)


def read_raw_credit_glued(spark: SparkSession, features_path: str, target_path: str,
                          features_fmt: str = "parquet", target_fmt: str = "parquet", sep: str = ",") -> DataFrame:
    """Features X1..X23 and target Y landed apart without ids, glued row by row; ids 1..n in row order.

    The sides may be split into other files and row groups; unlike row
    counts raise ``positions.UnequalRows``.
    """
    feats, f_cols = _credit(spark, features_path, features_fmt, True, False, sep,
                            only=[c for c in RAW_CREDIT_COLUMNS if c not in ("id", "is_default")])
    target, t_cols = _credit(spark, target_path, target_fmt, True, False, sep, only=("is_default",))
    back = {v: k for k, v in CREDIT_POSITIONAL_NAMES.items()}
    both = positions.glue(feats.select(*[back[n] for n, _, _ in f_cols]),
                          target.select(*[back[n] for n, _, _ in t_cols]), features_fmt, target_fmt, "_position")
    return both.select((F.col("_position") + 1).alias("id"), *[c for _, _, c in f_cols], *[c for _, _, c in t_cols]) \
        .select(*RAW_CREDIT_COLUMNS)


MALFORMED = "_malformed"


def split_rejected(df: DataFrame, columns: Sequence[tuple[str, Column, Column]], fmt: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): typed rows without a bad cell, and one row per bad cell of the others.

    Both come from one pass over the files, written under ``folder`` in two
    parts. A cell is bad if it holds a value that does not fit the declared
    type; a CSV line with too few or too many fields is bad as a whole (no
    column, the line as its raw value). ``good`` has the columns and
    ``position``; ``rejected`` has file, position, column_name, raw_value, reason.
    """
    spark = df.sparkSession
    kinds = {name: cast for name, _, cast in columns}
    bad = [F.when(raw.isNotNull() & (raw.cast("string") != "") & cast.isNull(),
                  F.struct(F.lit(name).alias("column_name"), raw.cast("string").alias("raw_value"),
                           F.lit(f"does not fit {kind}").alias("reason")))
           for (name, raw, cast), kind in zip(columns, [f.dataType.simpleString() for f in df.select(*kinds.values()).schema])]
    if MALFORMED in df.columns:
        bad.append(F.when(F.col(MALFORMED).isNotNull(), F.struct(
            F.lit(None).cast("string").alias("column_name"), F.col(MALFORMED).alias("raw_value"), F.lit("malformed line").alias("reason"))))
    placed = positions.positions(df, fmt, "_position", "_file")[0].select("_file", F.col("_position").alias("position"), *kinds.values(),
                                         F.filter(F.array(*bad), lambda x: x.isNotNull()).alias("_bad"))
    placed = placed.withColumn("_rejected", (F.size("_bad") > 0).cast("int"))
    placed.write.partitionBy("_rejected").parquet(folder)
    rows = spark.read.schema(placed.schema).parquet(folder)
    good = rows.filter("_rejected = 0").select("position", *kinds)
    cells = rows.filter("_rejected = 1").select(F.col("_file").alias("file"), "position", F.explode("_bad").alias("b"))
    return good, cells.select("file", "position", "b.column_name", "b.raw_value", "b.reason")


def read_marketing_quarantined(spark: SparkSession, path: str, folder: str, fmt: str = "csv",
                               sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Marketing records without bad cells, and the rejected cells (see ``split_rejected``).

    A file without ids gives every row its position + 1 as id, rejected rows
    counted, so a row keeps its id when its cells are mended.
    """
    df = file_columns(spark, path, fmt, [*RAW_MARKETING_COLUMNS, *MARKETING_RENAMES], sep)
    if fmt == "csv":
        schema = StructType([StructField(c, StringType()) for c in df.columns] + [StructField(MALFORMED, StringType())])
        df = (spark.read.schema(schema).option("header", "true").option("sep", sep).option("enforceSchema", "false")
              .option("columnNameOfCorruptRecord", MALFORMED).csv(path))
    df = reshape.rename_marketing(df)
    has_id = "id" in df.columns
    schema = StructType([f for f in RAW_MARKETING_SCHEMA.fields if has_id or f.name != "id"])
    columns = _select(df, path, schema, {f.name: f.name for f in schema.fields})
    good, rejected = split_rejected(df, columns, fmt, folder)
    if not has_id:
        good = good.withColumn("id", F.col("position") + 1)
    return good.select(*RAW_MARKETING_COLUMNS), rejected


def repeated_id(df: DataFrame) -> int | None:
    """One id that occurs twice or more, or None; the count collapses map-side."""
    dup = df.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    return dup[0]["id"] if dup else None


def join_by_id(features: DataFrame, target: DataFrame) -> DataFrame:
    """Two tables held apart put together on ``id``; rows without a partner stay, with NULLs (full outer)."""
    return features.join(target, "id", "full_outer")


def unmatched(features: DataFrame, target: DataFrame) -> dict[str, int]:
    """How many ids of each side have no partner."""
    sides = features.select("id", F.lit(1).alias("f")).join(target.select("id", F.lit(1).alias("t")), "id", "full_outer")
    row = sides.agg(F.count(F.when(F.col("t").isNull(), 1)).alias("features_only"),
                    F.count(F.when(F.col("f").isNull(), 1)).alias("target_only")).first()
    return row.asDict()


def read_raw_credit_split(spark: SparkSession, features_path: str, target_path: str,
                          fmt: str = "parquet", check_unique: bool = True) -> DataFrame:
    """Features and target landed apart (X1..X23 and Y, each with an id), put together on the id.

    A full outer join keeps the rows of either side without a partner. Ids
    must be unique on both sides, or rows would multiply; with
    ``check_unique`` a repeated id raises.
    """
    feat_cols = [c for c in RAW_CREDIT_COLUMNS if c != "is_default"]
    df, cols = _credit(spark, features_path, fmt, True, True, only=feat_cols)
    feat = df.select(*[c for _, _, c in cols])
    df, cols = _credit(spark, target_path, fmt, True, True, only=("id", "is_default"))
    tgt = df.select(*[c for _, _, c in cols])
    if check_unique:
        for side, frame in (("target", tgt), ("features", feat)):
            dup = repeated_id(frame)
            if dup is not None:
                raise ValueError(f"{side} file repeats id {dup}: the id join would multiply rows")
    return join_by_id(feat, tgt).select(*RAW_CREDIT_COLUMNS)


def read_raw_marketing(spark: SparkSession, path: str, fmt: str = "csv",
                       order_by: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Marketing records under source or table names; normalised, renamed, and given an id.

    When the file has no id, dense ids 1..n are assigned: in ``order_by`` order where it is given,
    else in the order of the rows in the files.
    """
    back = {v: k for k, v in MARKETING_RENAMES.items()}
    wanted = [*RAW_MARKETING_COLUMNS, *back.values()]
    df = reshape.rename_marketing(file_columns(spark, path, fmt, wanted, sep))
    has_id = "id" in df.columns
    schema = StructType([f for f in RAW_MARKETING_SCHEMA.fields if has_id or f.name != "id"])
    if not has_id and not order_by:
        columns = [c for _, _, c in _select(df, path, schema, {f.name: f.name for f in schema.fields})]
        return _numbered(df, columns, fmt).select(*RAW_MARKETING_COLUMNS)
    df = df.select(*[c for _, _, c in _select(df, path, schema, {f.name: f.name for f in schema.fields})])
    if not has_id:
        df = reshape.add_dense_id(df, order_by)
    return df.select(*RAW_MARKETING_COLUMNS)


INDICATOR_SERIES_SCHEMA = StructType([
    StructField("country_code", StringType()),
    StructField("year", IntegerType()),
    StructField("value", DoubleType()),
])


def _series(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """(country_code, year, value) of one series: long rows, or one row per country with a column per year."""
    wanted = [f.name for f in INDICATOR_SERIES_SCHEMA.fields]
    df = file_columns(spark, path, fmt, wanted)
    years = {c: c[2:] if c[:2].upper() == "YR" else c for c in df.columns}
    years = {c: y for c, y in years.items() if len(y) == 4 and y.isdigit()}
    if years and "value" not in df.columns:
        if "country_code" not in df.columns:
            raise MissingColumns(path, ["country_code"])
        wide = df.select("country_code", *[typed(F.col(f"`{c}`"), df.schema[c].dataType, DoubleType()).alias(y)
                                           for c, y in years.items()])
        return reshape.unpivot_years(wide, ["country_code"]).select(*wanted)
    return df.select(*[c for _, _, c in _select(df, path, INDICATOR_SERIES_SCHEMA, {c: c for c in wanted})])


def read_indicator_series(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                          recent: int | None = None, skipped: dict[str, str] | None = None) -> DataFrame:
    """Long (country_code, year, indicator, value) rows from per-indicator files.

    ``paths`` maps indicator code (or column name) -> path. A series that
    cannot be read (no such path, a broken file, missing columns) is skipped
    and named in ``skipped`` with the reason; it is an error when none can be
    read. ``recent`` keeps the most recent n years of a series as landed,
    empty years counted; empty values are dropped after that.
    """
    parts = []
    for code, path in paths.items():
        name = INDICATORS.get(code, code)
        try:
            s = _series(spark, path, fmt)
            s.take(1)
        except (PySparkException, MissingColumns) as e:
            if skipped is not None:
                skipped[code] = str(e).splitlines()[0][:300]
            continue
        parts.append(s.select("country_code", "year", F.lit(name).alias("indicator"), "value"))
    if not parts:
        raise RuntimeError("no indicator series could be read")
    long = reduce(DataFrame.unionByName, parts)
    long = reshape.recent_values(long, recent) if recent else long
    return long.filter(F.col("value").isNotNull())


def read_raw_macro(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                   recent: int = 25, skipped: dict[str, str] | None = None) -> DataFrame:
    """Wide macro panel from per-indicator files; missing indicators come out NULL."""
    return reshape.pivot_indicators(read_indicator_series(spark, paths, fmt, recent, skipped))
