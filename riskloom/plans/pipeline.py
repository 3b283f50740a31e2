"""The weekly batch job: raw -> staging -> intermediate -> marts -> checks -> roll-ups.

Staging stays lazy (a view: filters and column pruning reach the raw scan).
Every other table is written as a new version and published by a pointer
(see ``store``), and every downstream model reads the *written* table back,
so each layer cuts the lineage: a lost executor recomputes at most one layer,
and the model that feeds several consumers (segments -> ECL inputs -> two
marts) is computed once. A re-run replaces every output; a run that dies
leaves the tables published before.

Not-null, accepted-values and row-count checks are observed while the tables
are written. Only the unique checks read them; with ``buckets`` the tables
with ids are bucketed by id and that needs no exchange. The required
columns of the raw tables are read from the footers of all their files.
``failures`` lists what did not hold, and the shell entry point then ends with
exit code 1.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import intermediate, marts, quality, serving, staging
from riskloom.plans.layers import Layers
from riskloom.plans.store import Store, Version
from riskloom.session import scratch, size_shuffle_partitions
from riskloom.sources import footers
from riskloom.sources.schemas import CREDIT_POSITIONAL_NAMES, RAW_CREDIT_COLUMNS
from riskloom.sources.testtables import SOURCE_COLUMNS


@dataclass
class RawInputs:
    credit: DataFrame
    marketing: DataFrame
    macro: DataFrame
    #: Parquet inputs whose footers the job checks: name -> (frame, columns that every file must have)
    files: Mapping[str, tuple[DataFrame, Sequence[str]]] = field(default_factory=dict)
    #: cells of landed files that did not fit their type; their rows are not in the raw tables
    rejected: Mapping[str, DataFrame] = field(default_factory=dict)


def raw_from_tables(spark: SparkSession, sf_dir: str) -> RawInputs:
    lay = Layers(spark, sf_dir)
    return RawInputs(credit=lay.raw_credit, marketing=lay.raw_marketing, macro=lay.raw_macro,
                     files={t: (lay.table(t), cols) for t, cols in SOURCE_COLUMNS.items()})


#: tables with an id, in the order in which they are built from one another
ID_TABLES = ("raw_credit", "raw_marketing", "int_loan_delinquency", "int_portfolio_segments", "int_ecl_inputs")


def _write_all(jobs: Mapping[str, DataFrame], store: Store, layer: str, workers: int,
               checks: quality.WriteChecks | None = None, buckets: int = 0) -> dict[str, DataFrame]:
    """Write independent tables of one layer as concurrent Spark jobs, then publish them.

    Tables of one layer do not read each other, so their jobs can share the
    cluster (small jobs fill slots a big one leaves idle). Every job runs to
    the end before the first error, if any, is raised; nothing of the layer is
    published then.
    """
    def one(name: str) -> Version:
        df = checks.watch(name, jobs[name]) if checks else jobs[name]
        return store.write(df, layer, name, buckets if name in ID_TABLES else 0)

    if workers <= 1 or len(jobs) == 1:
        versions = {n: one(n) for n in jobs}
    else:
        with ThreadPoolExecutor(max_workers=min(workers, len(jobs))) as pool:
            futures = {n: pool.submit(one, n) for n in jobs}
            errors = [f.exception() for f in futures.values() if f.exception() is not None]
        if errors:
            raise errors[0]
        versions = {n: f.result() for n, f in futures.items()}
    for n, v in versions.items():
        store.publish(layer, n, v)
    return {n: store.read(layer, n, v) for n, v in versions.items()}


def run_pipeline(spark: SparkSession, raw: RawInputs, out_dir: str, with_serving: bool = True,
                 workers: int = 4, buckets: int = 0) -> dict[str, DataFrame]:
    """Build every layer under ``out_dir`` (a shared folder); returns the written tables.

    Layers run in order; the independent tables inside a layer are written
    by up to ``workers`` concurrent jobs. ``buckets`` > 0 buckets the tables
    with ids by id.
    """
    size_shuffle_partitions(spark, [raw.credit, raw.marketing])
    store, watch = Store(spark, out_dir), quality.WriteChecks()
    t: dict[str, DataFrame] = {}

    def build(layer: str, jobs: Mapping[str, DataFrame], checked: bool = True) -> None:
        t.update(_write_all(jobs, store, layer, workers, watch if checked else None, buckets))

    build("raw", {"raw_credit": raw.credit, "raw_marketing": raw.marketing, "raw_macro": raw.macro})

    if raw.rejected:
        build("quarantine", {f"quarantine_{n}": df for n, df in raw.rejected.items()}, checked=False)

    # staging: lazy views over the raw tables
    t["stg_credit_default"] = staging.stg_credit_default(t["raw_credit"])
    t["stg_bank_marketing"] = staging.stg_bank_marketing(t["raw_marketing"])
    t["stg_macro"] = staging.stg_macro(t["raw_macro"])

    # intermediate: stored tables
    build("intermediate", {"int_loan_delinquency": intermediate.int_loan_delinquency(t["stg_credit_default"])})
    build("intermediate", {"int_portfolio_segments": intermediate.int_portfolio_segments(t["int_loan_delinquency"])})
    build("intermediate", {"int_ecl_inputs": intermediate.int_ecl_inputs(t["int_portfolio_segments"])})

    # marts: stored tables
    build("marts", {
        "mart_portfolio_summary": marts.mart_portfolio_summary(t["int_portfolio_segments"]),
        "mart_npl_analysis": marts.mart_npl_analysis(t["int_ecl_inputs"]),
        "mart_ecl_estimates": marts.mart_ecl_estimates(t["int_ecl_inputs"]),
        "mart_vintage_curves": marts.mart_vintage_curves(t["stg_credit_default"],
                                                         dense_ids=not buckets and watch.dense_ids("raw_credit")),
        "mart_regulatory_ratios": marts.mart_regulatory_ratios(t["stg_macro"]),
    })

    # checks: what was observed on the way, unique keys by a scan, schemas by the footers
    observed = spark.createDataFrame(watch.results(t), quality.RESULT_SCHEMA)
    files = {**raw.files, **{n: (t[n], cols) for n, cols in quality.REQUIRED_COLUMNS.items()}}
    counts = quality.row_count_rows({n: watch.rows(n) for n, _, _ in quality.ROW_COUNT_RULES})
    build("checks", {
        "dq_checks": observed.unionByName(quality.run_checks(t, kinds=("unique",))),
        "dq_row_counts": spark.createDataFrame(counts, "table_name string, row_count bigint, rule string, passed boolean"),
        "dq_schema": footers.schema_results(spark, {n: df for n, (df, _) in files.items()}, {n: c for n, (_, c) in files.items()}),
    }, checked=False)

    if with_serving:
        build("pages", {
            "page_portfolio": serving.page_portfolio(t["mart_portfolio_summary"]),
            "page_risk": serving.page_risk(t["mart_npl_analysis"], t["mart_ecl_estimates"]),
        }, checked=False)
        build("serving", {key: fn(*[t[i] for i in inputs]) for key, (fn, inputs) in serving_plan().items()}, checked=False)
    return t


def failures(t: Mapping[str, DataFrame], row_counts: bool = False) -> list[str]:
    """What did not hold in a finished run: checks, required columns and, if asked for, the row-count rules."""
    out = [f"check failed: {r.model}.{r.column_name} {r.check_name}: {r.failing_rows}"
           for r in t["dq_checks"].filter("failing_rows > 0").collect()]
    out += [f"column missing: {r.table_name}.{r.column_name} in {r.file_name}" for r in footers.missing(t["dq_schema"]).collect()]
    if row_counts:
        out += [f"row count: {r.table_name} has {r.row_count}, not {r.rule}"
                for r in t["dq_row_counts"].filter("NOT passed").collect()]
    return out


def serving_plan() -> Mapping[str, tuple]:
    from riskloom.plans.catalog import SERVING
    return SERVING


def missing_required_columns(tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Schema check of the raw tables (metadata only)."""
    return {name: quality.missing_columns(tables[name], cols)
            for name, cols in quality.REQUIRED_COLUMNS.items()}


def raw_from_landed(spark: SparkSession, credit: str, marketing: str, macro: Mapping[str, str],
                    credit_format: str = "parquet", positional: bool = False,
                    marketing_format: str = "csv", marketing_sep: str = ",",
                    credit_order_by=None, marketing_order_by=None, quarantine: str | None = None) -> RawInputs:
    """Raw inputs from landed files (see ``riskloom.sources.landed``).

    With a ``quarantine`` folder, marketing rows with cells that do not fit
    their type are kept out of the raw table and listed cell by cell; without
    it such cells become NULL.
    """
    from riskloom.sources import landed
    files = {}
    if credit_format == "parquet":
        names = list(CREDIT_POSITIONAL_NAMES) if positional else [c for c in RAW_CREDIT_COLUMNS if c != "id"]
        files["landed_credit"] = (landed.file_columns(spark, credit, "parquet", names), names)
    rejected = {}
    if quarantine:
        contacts, rejected["raw_marketing"] = landed.read_marketing_quarantined(
            spark, marketing, os.path.join(quarantine, f"split-{uuid.uuid4().hex}"), marketing_format, marketing_sep)
    else:
        contacts = landed.read_raw_marketing(spark, marketing, marketing_format, marketing_order_by, marketing_sep)
    return RawInputs(
        files=files, rejected=rejected,
        credit=landed.read_raw_credit(spark, credit, credit_format, positional, credit_order_by),
        marketing=contacts,
        macro=landed.read_raw_macro(spark, macro))


def main(argv=None) -> int:
    """``python -m riskloom.plans.pipeline --out DIR (--tables DIR | --credit P --marketing P --macro CODE=P ...)``"""
    import argparse

    from riskloom.session import build_session

    ap = argparse.ArgumentParser(prog="riskloom.plans.pipeline")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--tables", help="folder of the test tables (derive the raw inputs)")
    ap.add_argument("--credit"), ap.add_argument("--marketing")
    ap.add_argument("--macro", nargs="*", default=[], help="indicator=path pairs")
    ap.add_argument("--positional", action="store_true", help="credit file uses X1..X23, Y names")
    ap.add_argument("--credit-format", default="parquet"), ap.add_argument("--marketing-format", default="csv")
    ap.add_argument("--marketing-sep", default=",")
    ap.add_argument("--credit-order-by", nargs="*", help="columns ordering credit rows (file has no id)")
    ap.add_argument("--marketing-order-by", nargs="*", help="columns ordering marketing rows (file has no id)")
    ap.add_argument("--no-serving", action="store_true")
    ap.add_argument("--quarantine", action="store_true", help="keep marketing rows with bad cells out and list the cells")
    ap.add_argument("--bucketed", action="store_true", help="bucket the tables with ids by id")
    ap.add_argument("--check-row-counts", action="store_true", help="fail on the row-count rules of the raw tables, too")
    a = ap.parse_args(argv)
    spark = build_session()
    if a.tables:
        raw = raw_from_tables(spark, a.tables)
    else:
        if not (a.credit and a.marketing and a.macro):
            ap.error("give --tables, or --credit, --marketing and --macro")
        raw = raw_from_landed(spark, a.credit, a.marketing, dict(kv.split("=", 1) for kv in a.macro),
                              a.credit_format, a.positional, a.marketing_format, a.marketing_sep,
                              a.credit_order_by, a.marketing_order_by,
                              os.path.join(a.out, "quarantine") if a.quarantine else None)
    with scratch(spark):
        t = run_pipeline(spark, raw, a.out, with_serving=not a.no_serving,
                         buckets=int(spark.conf.get("spark.sql.shuffle.partitions")) if a.bucketed else 0)
        failed = failures(t, a.check_row_counts)
    for line in failed:
        print(line)
    for n in raw.rejected:
        print(f"{n}: {t[f'quarantine_{n}'].select('position').distinct().count()} rows in quarantine")
    print(f"wrote {len(t)} tables under {a.out}; {len(failed)} checks failing")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())


__all__ = ["RawInputs", "raw_from_tables", "raw_from_landed", "run_pipeline", "missing_required_columns"]
