"""Times of the headline queries on the tables in $BENCH_SF_DIR, as one line of JSON.

The raw sources are first written as raw tables, which is not timed. Every query then runs whole,
once to warm up and three times for its median.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import datetime

from pyspark.sql import functions as F

from catalogue.case import CONTRACTS
from catalogue.derived import master
from catalogue.raw import load, raw_source
from catalogue.runs import deliver
from fieldlake.operators.cleaning import clean
from fieldlake.operators.dedupe import dedupe
from fieldlake.operators.lookup import lookup
from fieldlake.operators.models import build_model
from fieldlake.operators.quality import dq_report, reconcile
from fieldlake.plans import derive, reports
from fieldlake.plans.estate import BATCH_SOURCES, FACT_HARVEST, MODELS, SENSORS
from fieldlake.session import build_session, scratch_folder
from fieldlake.sources.batch import ingest_raw, read_table, write_table
from fieldlake.sources.layout import Layout
from fieldlake.streaming.live import drain, read_stream, silver_stream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = 3
RUN_TS = datetime(2024, 2, 1)


def consume(df):
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def prepare(spark):
    """Raw, cleaned and model tables of the estate."""
    layout = Layout(scratch_folder(spark, "bench"))
    parts = CPUS
    for name, contract in CONTRACTS.items():
        write_table(raw_source(spark, SF_DIR, name).repartition(parts), layout.bronze(name))
        write_table(clean(read_table(spark, layout.bronze(name)), contract, F.lit(RUN_TS)), layout.silver(name))
    for name, spec in MODELS.items():
        write_table(build_model(read_table(spark, layout.silver(spec.source)), spec), layout.gold(name))
    for name in CONTRACTS:
        deliver(read_table(spark, layout.bronze(name)).select(*CONTRACTS[name].column_names), layout.landing(name))
    return layout


def queries(spark, layout):
    bronze = {name: read_table(spark, layout.bronze(name)) for name in CONTRACTS}
    silver = {name: read_table(spark, layout.silver(name)) for name in CONTRACTS}
    gold = {name: read_table(spark, layout.gold(name)) for name in MODELS}
    lines, orders, suppliers = (load(spark, SF_DIR, name) for name in ("lineitem", "orders", "supplier"))
    tables = master(spark, SF_DIR)
    harvest = CONTRACTS["harvest"]

    def place(df):
        blocks = tables["blocks"].select(F.col("id").alias("_id"), "region_id")
        return lookup(df, blocks, {"block_id": "_id"}, {"region_id": derive.DEFAULT_REGION})

    def ingest_all():
        run = Layout(scratch_folder(spark, "raw"))
        for name, contract in BATCH_SOURCES.items():
            ingest_raw(spark, contract, layout.landing(name), run.bronze(name))

    def live():
        run = Layout(scratch_folder(spark, "live"))
        incoming = read_stream(spark, SENSORS, layout.landing("sensors"))
        drain(incoming, run.live_bronze("sensors"), run.checkpoint("bronze"))
        silver_stream(spark, SENSORS, run)

    return {
        "ingest_all_sources": ingest_all,
        "dedupe_lines": lambda: consume(dedupe(lines, ["l_orderkey", "l_linenumber"])),
        "clean_harvest": lambda: consume(clean(bronze["harvest"], harvest)),
        "clean_finance": lambda: consume(clean(bronze["finance"], CONTRACTS["finance"])),
        "fact_harvest": lambda: consume(build_model(silver["harvest"], FACT_HARVEST, unique_by=harvest.key)),
        "dq_report_harvest": lambda: consume(
            dq_report(silver["harvest"], harvest, as_of=RUN_TS.date(), raw=bronze["harvest"])
        ),
        "reconcile_finance": lambda: consume(reconcile(bronze["finance"], silver["finance"], CONTRACTS["finance"])),
        "ledger": lambda: consume(derive.ledger(silver, tables)),
        "enrich_hourly": lambda: consume(derive.enrich_hourly(place(silver["equipment"]), silver["weather"])),
        "lookup_shuffled": lambda: consume(
            lookup(lines, orders, {"l_orderkey": "o_orderkey"}, {"o_custkey": None}, unique=True)
        ),
        "lookup_hot_keys": lambda: consume(
            lookup(lines, suppliers, {"l_suppkey": "s_suppkey"}, {"s_name": "?"}, unique=True)
        ),
        "active_attendance": lambda: consume(
            derive.active_attendance(silver["hr"], derive.active_workers(silver["harvest"], silver["equipment"]))
        ),
        "overview": lambda: consume(reports.overview(gold)),
        "harvest_by_block": lambda: consume(reports.harvest_by(gold["fact_harvest"], "block_id")),
        "ledger_kpis": lambda: consume(reports.ledger_kpis(gold["fact_revenue"])),
        "ledger_top_accounts": lambda: consume(reports.ledger_top_accounts(gold["fact_revenue"])),
        "live_kpis": lambda: consume(reports.live_kpis(silver["sensors"])),
        "live_silver_stream": live,
    }


def main():
    spark = build_session("bench", master=f"local[{CPUS}]", shuffle_partitions=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, query in queries(spark, prepare(spark)).items():
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            query()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    result = {
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
