"""Files, streams and whole runs: the given tables written out as sources and taken in again."""

from datetime import datetime

from pyspark.sql import functions as F

from catalogue.case import CONTRACTS, case, silver
from catalogue.cleaning import DATES, TIMES
from catalogue.raw import load, raw_source, raw_sql
from catalogue.sections import LAST_STATUS
from catalogue.silver_sql import model_sql, silver_sql
from fieldlake.operators.cleaning import INGESTED_AT, clean
from fieldlake.plans.batch import run_batch
from fieldlake.plans.estate import BATCH_SOURCES, MODELS, SENSORS, SERVING
from fieldlake.plans.reports import merge_status_partials, merged_status, status_partials
from fieldlake.plans.serving import serving_rows, serving_views
from fieldlake.session import scratch_folder, scratch_run, shuffles_removed
from fieldlake.sources.batch import CSV_DIALECT, MALFORMED, ingest_raw, read_raw, read_source, read_table
from fieldlake.sources.inventory import compare_file_trees, landed_files
from fieldlake.sources.layout import Layout
from fieldlake.streaming.live import bronze_stream, run_live, silver_stream
from fieldlake.streaming.once import read_partials

RUN_TS = datetime(2024, 2, 1, 6, 0, 0)
# Writers of CSV keep the spaces of a text.
CSV_WRITE = {**CSV_DIALECT, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def deliver(df, path, **options):
    """Add rows to a folder of CSV files, as a source system does."""
    df.write.options(**CSV_WRITE, **options).mode("append").csv(path)


def csv_source(name):
    """Written as CSV, read with its contract's types, cleaned."""

    def run(spark, sf):
        path = scratch_folder(spark, name)
        deliver(raw_source(spark, sf, name), path)
        return clean(read_source(spark, CONTRACTS[name], path), CONTRACTS[name])

    return run


def raw_table(name):
    """Written as CSV, copied to a raw table, read back as text."""

    def run(spark, sf):
        layout = Layout(scratch_folder(spark, name))
        deliver(raw_source(spark, sf, name), layout.landing(name))
        ingest_raw(spark, CONTRACTS[name], layout.landing(name), layout.bronze(name))
        return read_table(spark, layout.bronze(name)).select(*CONTRACTS[name].column_names)

    return run


def raw_table_sql(name):
    """An empty text cannot be told from a missing one in CSV; both come back as NULL."""
    listed = ", ".join(f"nullif({column}, '') as {column}" for column in CONTRACTS[name].column_names)
    return f"select {listed} from ({raw_sql(name)})"


def line_breaks(spark, sf):
    """Notes with line breaks and quotes in them, written as CSV and read back as text, cut by many tasks."""
    path = scratch_folder(spark, "breaks")
    deliver(raw_source(spark, sf, "fertilizer").withColumn("notes", F.concat(F.lit('two\nlines, "'), "application_id", F.lit('"\n'))), path)
    return read_raw(spark, CONTRACTS["fertilizer"], path).select(*CONTRACTS["fertilizer"].column_names, MALFORMED)


def line_breaks_sql():
    listed = ", ".join(f"nullif({c}, '') as {c}" for c in CONTRACTS["fertilizer"].column_names if c != "notes")
    notes = "'two' || chr(10) || 'lines, \"' || application_id || '\"' || chr(10)"
    return f"select {listed}, {notes} as notes, cast(null as varchar) as {MALFORMED} from ({raw_sql('fertilizer')})"


def live_table(spark, sf, deliveries):
    """The cleaned live table after each delivery, if there is one, went through both streams."""
    layout = Layout(scratch_folder(spark, "live"))
    runs = []
    for rows in deliveries:
        if rows is not None:
            deliver(rows, layout.incoming(SENSORS.name))
        runs.append(run_live(spark, SENSORS, layout))
    return read_table(spark, layout.live_silver(SENSORS.name)).drop(INGESTED_AT), runs


def redelivered(spark, sf):
    """Every file is delivered twice; the second delivery adds nothing."""
    raw = raw_source(spark, sf, "sensors")
    return live_table(spark, sf, [raw, raw])[0]


def rerun(spark, sf):
    """Rows that three runs add and leave: a delivery, the same delivery again, and no delivery."""
    raw = raw_source(spark, sf, "sensors")
    runs = live_table(spark, sf, [raw, raw, None])[1]
    rows = [
        (i + 1, run.bronze_rows, run.silver_rows, run.bronze_total, run.silver_total) for i, run in enumerate(runs)
    ]
    kinds = "run int, bronze_rows bigint, silver_rows bigint, bronze_total bigint, silver_total bigint"
    return spark.createDataFrame(rows, kinds)


def running_status(spark, sf):
    """The status of all sensors from the figures that two deliveries left; the readings are not looked at."""
    raw = raw_source(spark, sf, "sensors")
    layout = Layout(scratch_folder(spark, "status"))
    early = F.col("timestamp") < "2024-01-15"
    for part in (raw.where(early), raw.where(~early)):
        deliver(part, layout.incoming(SENSORS.name))
        bronze_stream(spark, SENSORS, layout)
        silver_stream(spark, SENSORS, layout, partials=status_partials, merge=merge_status_partials)
    return merged_status(read_partials(spark, layout.live_partials(SENSORS.name)), last_status=True)


def late_rows(spark, sf):
    """The table delivered newest first in three parts, with a horizon of one day.

    Each run knows the newest time the runs before it saw, and drops what is older than a day
    before that.
    """
    raw = raw_source(spark, sf, "sensors")
    layout = Layout(scratch_folder(spark, "late"))
    second, third = F.col("timestamp") < "2024-01-21", F.col("timestamp") < "2024-01-11"
    for part in (raw.where(~second), raw.where(second & ~third), raw.where(third)):
        deliver(part, layout.incoming(SENSORS.name))
        run_live(spark, SENSORS, layout, late_horizon="1 day")
    return read_table(spark, layout.live_silver(SENSORS.name)).drop(INGESTED_AT)


def landed_twice(spark, sf, layout, sources=tuple(BATCH_SOURCES), **options):
    """Sources that pass the gate: cleaned rows as text, every row delivered twice."""
    for name in sources:
        contract = BATCH_SOURCES[name]
        rows = silver(spark, sf, name).dropna(subset=list(contract.key))
        text = rows.select(*[F.col(c).cast("string").alias(c) for c in contract.column_names])
        with shuffles_removed(spark):
            deliver(text.unionByName(text), layout.landing(name, contract.file_name), **options)


def contents(df):
    """A number for the rows of a table, whatever their order: hashes added up."""
    rows = F.xxhash64(*df.columns).cast("decimal(20,0)")
    return df.agg(F.coalesce(F.sum(rows).cast("string"), F.lit("none"))).first()[0]


def batch_rerun(spark, sf):
    """The whole batch run, twice over the same sources: rows per table after each, and whether the
    two left the same contents. Raw tables keep the source's rows and the names of its files.

    All layers of all sources lie on disk together. So the files are delivered compressed, tables are built
    one at a time, each goes when the second run has replaced it, and all go at the end."""
    with scratch_run(spark, "batch") as folder:
        layout = Layout(folder, kept_versions=1)
        landed_twice(spark, sf, layout, compression="gzip")
        paths = {("bronze", name): layout.bronze(name) for name in BATCH_SOURCES}
        paths |= {("silver", name): layout.silver(name) for name in BATCH_SOURCES}
        paths |= {("gold", name): layout.gold(name) for name in MODELS}
        runs, seen = [], []
        for _ in range(2):
            runs.append(run_batch(spark, layout, RUN_TS, side_by_side=1))
            with shuffles_removed(spark):
                seen.append({at: contents(read_table(spark, path)) for at, path in paths.items()})
    rows = [
        (layer, name, *(getattr(run, layer)[name] for run in runs), seen[0][layer, name] == seen[1][layer, name])
        for layer, name in paths
    ]
    kinds = "layer string, table_name string, first_rows bigint, second_rows bigint, same_contents boolean"
    return spark.createDataFrame(rows, kinds)


def view_rows(model):
    """A serving view over the tables of a batch run."""
    source = MODELS[model].source

    def run(spark, sf):
        layout = Layout(scratch_folder(spark, "views"))
        landed_twice(spark, sf, layout, [source])
        run_batch(spark, layout, RUN_TS, sources=[source])
        return serving_views(spark, layout, {model: SERVING[model]})[model]

    return run


def rows_where(model, where):
    """Rows of a fact after a batch run, from the files that the index names."""
    source = MODELS[model].source

    def run(spark, sf):
        layout = Layout(scratch_folder(spark, "rows"))
        landed_twice(spark, sf, layout, [source])
        run_batch(spark, layout, RUN_TS, sources=[source])
        return serving_rows(spark, layout, model, where)

    return run


MONTH_OF_ROWS = ("1996-03-01", "1996-03-31")


def view_case(model, run=None, condition="true"):
    kinds = SERVING[model].columns
    keys = " and ".join(f"{key} is not null" for key in MODELS[model].key)
    return case(
        run or view_rows(model),
        f"select * from ({model_sql(model)}) where {keys} and {condition}",
        dates=tuple(name for name, kind in kinds.items() if kind == "date"),
        times=tuple(name for name, kind in kinds.items() if kind == "datetime2"),
        decimals=tuple(name for name, kind in kinds.items() if kind.startswith("decimal")),
    )


def _deliver_by_nation(df, path):
    """Customers as lines of text, a folder for each nation and one file in it."""
    line = F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("value")
    rows = df.select(line, F.col("c_nationkey").alias("nation")).repartition("nation")
    rows.sortWithinPartitions("nation", "value").write.partitionBy("nation").text(path)


def two_deliveries(spark, sf):
    """Two deliveries of the customers. In the second the customers of nation 3 have a new name and
    those of nation 5 come under nation 105."""
    left, right = scratch_folder(spark, "left"), scratch_folder(spark, "right")
    customers = load(spark, sf, "customer")
    _deliver_by_nation(customers, left)
    renamed = F.when(F.col("c_nationkey") == 3, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name"))
    moved = F.when(F.col("c_nationkey") == 5, 105).otherwise(F.col("c_nationkey"))
    _deliver_by_nation(customers.withColumns({"c_name": renamed, "c_nationkey": moved}), right)
    return compare_file_trees(spark, left, right, by_folder=True).select("file", "status", "left_lines", "right_lines")


TWO_DELIVERIES_SQL = """
with a as (select c_nationkey as k, count(*) as n from customer group by 1),
b as (select case when c_nationkey = 5 then 105 else c_nationkey end as k, count(*) as n from customer group by 1)
select 'nation=' || coalesce(a.k, b.k) as file,
       case when b.k is null then 'left_only' when a.k is null then 'right_only'
            when a.k = 3 then 'changed' else 'same' end as status,
       a.n as left_lines, b.n as right_lines
from a full join b on a.k = b.k
"""

LOST, STRANGER = "weather", "rain"


def landing_check(spark, sf):
    """All sources landed but one, and one that no contract names."""
    layout = Layout(scratch_folder(spark, "landing"))
    for name, contract in BATCH_SOURCES.items():
        where = layout.landing(STRANGER, "rain.csv") if name == LOST else layout.landing(name, contract.file_name)
        deliver(raw_source(spark, sf, name), where)
    found = landed_files(spark, layout, BATCH_SOURCES)
    name = F.regexp_extract("name", "^[^/]*", 0).alias("name")
    return found.groupBy(name, "status").agg(F.max("rows").alias("rows"))


LANDING_SQL = " union all ".join(
    [f"select '{name}' as name, 'ok' as status, (select count(*) from ({raw_sql(name)})) as rows"
     for name in BATCH_SOURCES if name != LOST]
    + [f"select '{LOST}', 'missing', null", f"select '{STRANGER}', 'stranger', null"]
)


def hot_reading(spark, sf):
    """Rows that one reading makes of itself: every event under one key, in one delivery and again in a second."""
    raw = raw_source(spark, sf, "sensors").withColumns(
        {"sensor_id": F.lit("s1"), "timestamp": F.lit("2024-01-01 00:00:00")}
    )
    table, runs = live_table(spark, sf, [raw, raw.coalesce(1)])
    rows = [(i + 1, run.bronze_rows, run.silver_rows, run.silver_total) for i, run in enumerate(runs)]
    return spark.createDataFrame(rows, "run int, bronze_rows bigint, silver_rows bigint, silver_total bigint")


def _landed_sql(name):
    keys = " and ".join(f'"{key}" is not null' for key in BATCH_SOURCES[name].key)
    return f"select * from ({silver_sql(name)}) where {keys}"


def _count(table, layer, sql, times=1):
    return f"select '{layer}' as layer, '{table}' as table_name, {times} * count(*) as first_rows, {times} * count(*) as second_rows, true as same_contents from ({sql})"


def _model_count_sql(model):
    spec = MODELS[model]
    key = ", ".join(spec.key)
    return f"select distinct {key} from ({_landed_sql(spec.source)}) where {spec.required[0]} is not null"


RERUN_SQL = " union all ".join(
    [_count(name, "bronze", _landed_sql(name), 2) for name in BATCH_SOURCES]
    + [_count(name, "silver", _landed_sql(name)) for name in BATCH_SOURCES]
    + [_count(name, "gold", _model_count_sql(name)) for name in MODELS]
)

LIVE = silver_sql("sensors")


def cases():
    found = {
        "live_table": case(redelivered, LIVE, times=("timestamp",)),
        "live_rerun": case(
            rerun,
            f"""select i as run, case when i < 3 then n else 0 end as bronze_rows, case when i = 1 then m else 0 end
                as silver_rows, least(i, 2) * n as bronze_total, m as silver_total
                from (select unnest([1, 2, 3]) as i), (select count(*) as n from events),
                (select count(*) as m from ({LIVE}))""",
        ),
        "live_hot_reading": case(
            hot_reading,
            """select i as run, count(*) as bronze_rows, cast(case when i = 1 then 1 else 0 end as bigint) as silver_rows,
               cast(1 as bigint) as silver_total from (select unnest([1, 2]) as i), events group by i""",
        ),
        "live_running_status": case(running_status, LAST_STATUS, times=("last_reading_ts",)),
        "live_late_rows": case(
            late_rows,
            f"""select * from ({LIVE}) where "timestamp" >= '2024-01-21' """,
            times=("timestamp",),
        ),
        "csv_line_breaks": case(line_breaks, line_breaks_sql()),
        "batch_rerun": case(batch_rerun, RERUN_SQL),
        "same_files": case(two_deliveries, TWO_DELIVERIES_SQL),
        "landing_check": case(landing_check, LANDING_SQL),
    }
    for name in BATCH_SOURCES:
        found[f"csv_{name}"] = case(
            csv_source(name),
            silver_sql(name),
            times=TIMES[name],
            dates=DATES.get(name, ()),
            decimals=("amount",) if name == "finance" else (),
        )
        found[f"raw_table_{name}"] = case(raw_table(name), raw_table_sql(name))
    for model in SERVING:
        found[f"view_{model}"] = view_case(model)
    low, high = MONTH_OF_ROWS
    found["rows_of_a_month"] = view_case(
        "fact_harvest", rows_where("fact_harvest", {"harvest_date": MONTH_OF_ROWS}), f"harvest_date between '{low}' and '{high}'"
    )
    return found
