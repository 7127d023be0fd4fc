"""Bulk extract, initial load and incremental load."""

import logging
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from storelake.operators import dims, facts
from storelake.operators.clean import CORRUPT, cast_to, clean, complete, distinct_rows, drop_counts, normalize_names, with_corrupt
from storelake.operators.incremental import not_in
from storelake.operators.watermarks import append_newer
from storelake.schemas import BATCH_TABLES, GOLD_TABLES
from storelake.sinks.files import (
    append_delta,
    folder_exists,
    observed,
    overwrite,
    stored,
    stored_counted,
    write_csv_counted,
)
from storelake.sources.files import read_csv, read_table

log = logging.getLogger(__name__)

# Loads one Gold table into the warehouse: called with the frame and the table name.
Warehouse = Callable[[DataFrame, str], None]

MODES = ("initial", "incremental")

T = TypeVar("T")


@dataclass(frozen=True)
class Lake:
    """Folders of the three layers under one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


def together(spark: SparkSession, **jobs: Callable[[], T]) -> dict[str, T]:
    """Submit independent Spark jobs at once, so that a small table does not hold up the cluster."""
    submit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(submit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}


def extract(spark: SparkSession, sources: Mapping[str, DataFrame], lake: Lake) -> dict[str, int]:
    """Source tables to compressed Bronze CSV, written in parallel by the executors. Returns the rows written per table."""
    return together(
        spark,
        **{name: partial(write_csv_counted, source, f"{lake.bronze}/{name}") for name, source in sources.items()},
    )


def bronze_to_silver(
    spark: SparkSession, lake: Lake, multi_line: Collection[str] = (), extracted: Mapping[str, int] | None = None
) -> dict[str, dict[str, int]]:
    """Clean the Bronze files into Silver and return, per table, the rows kept and those dropped by reason.

    Reasons are ``malformed`` (a cell is missing or cannot be read, which leaves a null), ``nulls`` (an empty cell or NaN) and
    ``repeated``. They are counted by the tasks that look for repeated rows.

    Name the tables whose text holds line breaks in ``multi_line``; their files are not split. Given the
    rows that were extracted, a table read with another number of rows is an error: a line break has cut a row.
    """

    def refine(name: str) -> dict[str, int]:
        counter = Observation()
        bronze = read_csv(spark, f"{lake.bronze}/{name}", with_corrupt(BATCH_TABLES[name]), name in multi_line)
        counts = [c.alias(n) for n, c in drop_counts(BATCH_TABLES[name]).items()]
        whole, watched = (complete(normalize_names(b.drop(CORRUPT))) for b in (bronze, bronze.observe(counter, *counts)))
        _, kept = stored_counted(distinct_rows(whole, watched), f"{lake.silver}/{name}")
        found = observed(counter, lambda: bronze.agg(*counts).first().asDict())
        read = found["rows"]
        wanted = (extracted or {}).get(name, read)
        if read != wanted:
            raise ValueError(
                f"{wanted} rows of {name} were extracted, but {read} read; "
                "name the table in multi_line if its text holds line breaks"
            )
        dropped = {reason: found[reason] for reason in ("malformed", "nulls")}
        log.info("%s: %s kept of %s, %s", name, kept, read, dropped)
        return {"kept": kept, **dropped, "repeated": read - kept - sum(dropped.values())}

    return together(spark, **{name: partial(refine, name) for name in BATCH_TABLES})


def read_silver(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Silver tables under their declared schemas, without a look into the files."""
    return {
        name: spark.read.schema(schema).parquet(f"{lake.silver}/{name}") for name, schema in BATCH_TABLES.items()
    }


def build_gold(
    spark: SparkSession,
    lake: Lake,
    load_type: str,
    run_ts: datetime,
    warehouse: Warehouse | None = None,
    unchanged: Collection[str] = (),
) -> None:
    """Rebuild the star from Silver, each table computed once, but for dimensions named as ``unchanged`` that are there.

    Facts join the written dimensions, and the warehouse is loaded from the written tables, so
    every consumer sees the same rows.
    """
    silver = read_silver(spark, lake)

    def made(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{lake.gold}/{name}"
        kept = name in unchanged and folder_exists(spark, f"{path}/_SUCCESS")
        return read_table(spark, path) if kept else stored(build(), path)

    gold = together(
        spark,
        customers=lambda: made("dim_customer", lambda: dims.dim_customer(silver["customers"])),
        products=lambda: made("dim_product", lambda: dims.dim_product(silver["products"])),
        payments=lambda: made("dim_payment", lambda: dims.dim_payment(silver["transactions"])),
        dates=lambda: made("dim_date", lambda: dims.dim_date(silver["transactions"])),
    )
    sales = facts.fact_transactions(
        silver["transactions"], gold["customers"], gold["products"], gold["payments"], load_type, run_ts
    )
    visits = facts.fact_behavior(silver["behavior"], gold["customers"], load_type, run_ts)
    together(
        spark,
        transactions=lambda: overwrite(sales, f"{lake.gold}/fact_transactions"),
        behavior=lambda: overwrite(visits, f"{lake.gold}/fact_behavior"),
    )
    if warehouse:
        together(
            spark, **{name: partial(warehouse, read_table(spark, f"{lake.gold}/{name}"), name) for name in GOLD_TABLES}
        )


def initial_load(
    spark: SparkSession,
    lake: Lake,
    run_ts: datetime,
    warehouse: Warehouse | None = None,
    multi_line: Collection[str] = (),
    extracted: Mapping[str, int] | None = None,
) -> dict[str, int]:
    """Bronze to Silver to Gold, then the warehouse. Returns the Silver rows per table."""
    refined = bronze_to_silver(spark, lake, multi_line, extracted)
    build_gold(spark, lake, "INITIAL", run_ts, warehouse)
    return {name: counts["kept"] for name, counts in refined.items()}


def incremental_load(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    run_ts: datetime,
    warehouse: Warehouse | None = None,
    cast_then_clean: bool = False,
    key_order: str = "lexicographic",
) -> dict[str, int]:
    """Append new customers, products and behavior to Silver, then rebuild Gold in full.

    Every fact row carries the mode and time of this run. Values are cast after cleaning, so
    one that does not convert reaches Silver as null; ``cast_then_clean`` drops its row instead.
    ``key_order`` says how watermarks compare keys. Returns the number of rows appended per table.
    """
    silver = read_silver(spark, lake)

    def conformed(name: str) -> DataFrame:
        schema = BATCH_TABLES[name]
        return clean(cast_to(sources[name], schema)) if cast_then_clean else cast_to(clean(sources[name]), schema)

    def above(name: str, key: str) -> int:
        return append_newer(conformed(name), silver[name], f"{lake.silver}/{name}", key, key_order)

    def unseen(name: str, key: str) -> int:
        return append_delta(not_in(conformed(name), silver[name], key), f"{lake.silver}/{name}")

    # Each job finds its own watermark or stored keys, so that these run side by side too.
    appended = together(
        spark,
        customers=partial(above, "customers", "customer_id"),
        products=partial(above, "products", "product_id"),
        behavior=partial(unseen, "behavior", "customer_id"),
    )
    # An increment brings no transactions, so what is made of them alone stays.
    build_gold(spark, lake, "INCREMENTAL", run_ts, warehouse, unchanged=("dim_payment", "dim_date"))
    return appended


def run(
    spark: SparkSession,
    mode: str,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    run_ts: datetime,
    warehouse: Warehouse | None = None,
    multi_line: Collection[str] = (),
    cast_then_clean: bool = False,
    key_order: str = "lexicographic",
) -> dict[str, int]:
    """Route a run by its mode: ``initial`` extracts and loads everything, ``incremental`` adds what is new.

    ``multi_line`` belongs to the initial load, ``cast_then_clean`` and ``key_order`` to the incremental one. Returns
    the rows that entered Silver per table.
    """
    if mode == "initial":
        extracted = extract(spark, sources, lake)
        entered = initial_load(spark, lake, run_ts, warehouse, multi_line, extracted)
    elif mode == "incremental":
        entered = incremental_load(spark, lake, sources, run_ts, warehouse, cast_then_clean, key_order)
    else:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode!r}")
    log.info("%s load: %s", mode, entered)
    return entered
