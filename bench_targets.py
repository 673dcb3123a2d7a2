"""Measure the four design choices: split reading, growth, upsert, label maps.

Usage: python bench_targets.py [sf_dir]
"""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appendlake.operators import labels, ledger
from appendlake.plans.copying import copy_growth
from appendlake.plans.loading import load_entity
from appendlake.queries.catalog import table
from appendlake.queries.file_jobs import DOCUMENTS, ORDERS, _order_rows, export, new_lake
from appendlake.session import scratch_dir
from appendlake.sinks import RunFolderSink, VersionedSink
from appendlake.sinks.versions import current
from appendlake.sources import records

MIB = 1 << 20


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, times: int = 3) -> float:
    seconds = []
    for _ in range(times):
        started = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - started)
    return round(min(seconds), 2)


def grown_file(spark: SparkSession, sf_dir: str, folder: str, copies: int) -> str:
    """One file with the documents several times over."""
    part = scratch_dir(spark, "part")
    export(table(spark, sf_dir, "documents").coalesce(1), part)
    with open(glob.glob(f"{part}/*.csv")[0], "rb") as source:
        data = source.read()
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/documents.csv", "wb") as out:
        for _ in range(copies):
            out.write(data)
    return f"{folder}/documents.csv"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    lake = new_lake(spark, "targets", chunk_bytes=32 * MIB)
    path = grown_file(spark, sf_dir, f"{lake.source_root}/documents", 20)
    print("file bytes", os.path.getsize(path))
    print("a whole-file scan", best(lambda: run(records.read(spark, [path], DOCUMENTS, False))))
    print("a split scan", best(lambda: run(records.read_split(spark, [path], DOCUMENTS, 32 * MIB))))

    first = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

    def copy_and_load(step: int) -> None:
        at = first + dt.timedelta(minutes=step)
        copy_growth(spark, lake, ["documents"], run_ts=at)
        load_entity(spark, lake, "documents", DOCUMENTS, RunFolderSink(lake), run_ts=at)

    print("b first copy and load", best(lambda: copy_and_load(0), 1))
    paths = [r[0] for r in ledger.available(spark, lake, "documents").select("target").collect()]
    print("b scan of range files", best(lambda: run(records.read(spark, paths, DOCUMENTS, False))))
    with open(path, "rb") as source:
        more = source.read(os.path.getsize(path) // 100)
    with open(path, "ab") as out:
        out.write(more[: more.rfind(b'"\n"') + 2])
    print("b copy and load of 1 % growth", best(lambda: copy_and_load(1), 1))

    orders = new_lake(spark, "orders", chunk_bytes=8 * MIB, bucket_count=64)
    rows = _order_rows(spark, sf_dir).drop("o_orderdate")
    export(rows, f"{orders.source_root}/orders")

    def load(mode: str) -> float:
        copy_growth(spark, orders, ["orders"])
        return best(lambda: load_entity(spark, orders, "orders", ORDERS, VersionedSink(orders), mode), 1)

    print("c first load", load("append"))
    few = rows.where(F.col("versionnumber") == rows.agg(F.max("versionnumber")).first()[0])
    export(few.withColumn("totalprice", F.col("totalprice") * 2), f"{orders.source_root}/orders")
    print("c upsert of one customer's orders", load("upsert"), "rows", current(spark, orders, "orders").count())
    export(rows.withColumn("totalprice", F.col("totalprice") * 2), f"{orders.source_root}/orders")
    print("c upsert of all orders", load("upsert"), "rows", current(spark, orders, "orders").count())

    coded = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        *[F.pmod(F.col(c), F.lit(25)).alias(f"code{i}") for i, c in
          enumerate(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber") * 3)],
    )
    nations = table(spark, sf_dir, "nation")
    found = None
    for i in range(12):
        one = nations.select(
            F.lit("lines").alias("EntityName"), F.lit(True).alias("IsUserLocalizedLabel"),
            F.col("n_name").alias("LocalizedLabel"), F.lit(1040).cast("bigint").alias("LocalizedLabelLanguageCode"),
            F.col("n_nationkey").cast("bigint").alias("Option"), F.lit(f"code{i}").alias("OptionSetName"),
            F.lit(False).alias("IsGlobal"),
        )
        found = one if found is None else found.unionByName(one)
    print("d twelve label joins", best(lambda: run(labels.enrich(coded, found))))


if __name__ == "__main__":
    main()
