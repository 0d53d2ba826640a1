"""The reports of every section."""

from datetime import datetime

from catalogue.case import case, gold, silver
from catalogue.silver_sql import model_sql, silver_sql
from fieldlake.plans import reports as r
from fieldlake.plans.estate import MODELS

HARVEST, REVENUE = model_sql("fact_harvest"), model_sql("fact_revenue")
FERTILIZER, OPERATIONS = model_sql("fact_fertilizer"), model_sql("fact_equipment")
FLEET, PEOPLE = model_sql("dim_equipment"), model_sql("dim_employee")
READINGS = silver_sql("sensors")


def _on(model, report, *arguments):
    return lambda spark, sf: report(gold(spark, sf, model), *arguments)


def _live(report, *arguments, **options):
    return lambda spark, sf: report(silver(spark, sf, "sensors"), *arguments, **options)


def _sum(column, name):
    return f"cast(sum(cast({column} as decimal(28,4))) as double) as {name}"


def _mean(column, name):
    return f"cast(sum(cast({column} as decimal(28,10))) as double) / nullif(count({column}), 0) as {name}"


def _group(table, by, listed, keep_null=False):
    condition = "" if keep_null else f"where {by} is not null"
    return f"select {by}, {listed} from ({table}) {condition} group by {by}"


def _top(sql, value, key):
    return f"select * from ({sql}) order by {value} desc nulls last, {key} nulls first limit 10"


KG, QTY = _sum("harvested_weight_kg", "kg"), _sum("quantity_kg", "kg")
AMOUNT = "cast(sum(amount) as double) as amount"
MINUTES = "cast(sum(duration_minutes) as bigint) as minutes"
WORKFORCE = f"select role, department, cost_center_id, count(*) as people from ({PEOPLE}) group by all"
STATUS = f"""select block_id, sensor_id, max("timestamp") as last_reading_ts, count(*) as reading_count,
    count(*) filter (where sensor_status = 'OK') as ok_count,
    count(*) filter (where sensor_status = 'ANOMALY') as anomaly_count,
    count(*) filter (where sensor_status = 'FAULT') as fault_count,
    {_mean('battery_level_pct', 'avg_battery_pct')} from ({READINGS}) group by block_id, sensor_id"""

LAST_STATUS = f"""select s.*, l.sensor_status as last_status from ({STATUS}) s join
    (select *, row_number() over (partition by block_id, sensor_id
     order by "timestamp" desc, sensor_status desc nulls last) as rank_in_key from ({READINGS})) l
    on l.rank_in_key = 1 and l.sensor_id = s.sensor_id and l.block_id = s.block_id"""

# A stretch of time and the width of a chart of it.
STRETCH, WIDTH = (datetime(2024, 1, 3), datetime(2024, 1, 23)), 24


def _reduced_sql(measure):
    start, step = STRETCH[0].isoformat(" "), (STRETCH[1] - STRETCH[0]).total_seconds() / WIDTH
    points = (("min", "t, v"), ("max", "t, v"), ("min", "v, t"), ("max", "v, -t"))
    picked = [
        f"{how}(struct_pack({', '.join(f'p{i} := {e}' for i, e in enumerate(order.split(', ')))})) as e{n}"
        for n, (how, order) in enumerate(points)
    ]
    shown = ("e0.p0 as t, e0.p1 as v", "e1.p0, e1.p1", "e2.p1, e2.p0", "-e3.p1, e3.p0")
    parts = " union ".join(f"select sensor_id, bucket, {columns} from held" for columns in shown)
    return f"""with r as (
            select sensor_id, epoch_us("timestamp") as t, {measure} as v from ({READINGS})
            where {measure} is not null and "timestamp" >= timestamp '{start}' and "timestamp" < timestamp '{STRETCH[1].isoformat(" ")}'
        ),
        held as (
            select sensor_id, cast(floor((t - epoch_us(timestamp '{start}')) / 1e6 / {step}::double) as bigint) as bucket,
                   {", ".join(picked)} from r group by all
        )
        select sensor_id, bucket, make_timestamp(t) as reading_ts, v as {measure} from ({parts})"""


def _overview(spark, sf):
    return r.overview({name: gold(spark, sf, name) for name in MODELS})


def _selection(spark, sf):
    chosen = r.harvest_selection(gold(spark, sf, "fact_harvest"), ["BLK01", "BLK17"], ["TEA", "RUBBER"])
    return r.harvest_kpis(chosen)


def _equipment(spark, sf):
    return r.equipment_kpis(gold(spark, sf, "fact_equipment"), gold(spark, sf, "dim_equipment"))


def _harvest_kpis_sql(condition="true"):
    return f"""select {KG}, count(*) as operations, count(*) filter (where status = 'COMPLETED') as completed,
        case when count(*) > 0 then cast(100 * count(*) filter (where status = 'COMPLETED') as double) / count(*)
             else 0.0 end as completion_rate,
        {_mean('moisture_pct', 'avg_moisture')} from ({HARVEST}) where {condition}"""


STATUS_COLUMNS = {
    "harvest": "status",
    "fertilizer": "application_status",
    "equipment": "status",
    "hr": "attendance_status",
    "sensors": "sensor_status",
}


def cases():
    found = {
        "status_mix": case(
            lambda spark, sf: r.status_mix({n: (silver(spark, sf, n), c) for n, c in STATUS_COLUMNS.items()}),
            " union all ".join(
                f"select '{n}' as source, {c} as status, count(*) as rows from ({silver_sql(n)}) group by {c}"
                for n, c in STATUS_COLUMNS.items()
            ),
        ),
        "overview": case(
            _overview,
            f"""select count(*) as operations, {KG}, (select cast(sum(amount) as double) from ({REVENUE})) as amount,
                (select count(*) from ({FLEET})) as machines, (select count(*) from ({PEOPLE})) as people
                from ({HARVEST})""",
        ),
        "overview_trend": case(
            _on("fact_harvest", r.overview_trend), _group(HARVEST, "harvest_date", KG, True), dates=("harvest_date",)
        ),
        "overview_by_crop": case(
            _on("fact_harvest", r.overview_by_crop), _group(HARVEST, "crop_type", KG, True)
        ),
        "overview_top_blocks": case(
            _on("fact_harvest", r.overview_top_blocks),
            _top(_group(HARVEST, "block_id", f"{KG}, count(*) as operations", True), "kg", "block_id"),
        ),
        "harvest_kpis": case(_on("fact_harvest", r.harvest_kpis), _harvest_kpis_sql()),
        "harvest_selection": case(
            _selection,
            _harvest_kpis_sql("block_id in ('BLK01', 'BLK17') and crop_type in ('TEA', 'RUBBER')"),
        ),
        "harvest_trend": case(
            _on("fact_harvest", r.harvest_trend), _group(HARVEST, "harvest_date", KG), dates=("harvest_date",)
        ),
        "harvest_by_grade": case(
            _on("fact_harvest", r.harvest_by_grade),
            _group(HARVEST, "quality_grade", "count(harvested_weight_kg) as operations"),
        ),
        "ledger_kpis": case(
            _on("fact_revenue", r.ledger_kpis),
            f"""select cast(sum(amount) as double) as gross,
                cast(sum(amount) filter (where debit_credit_indicator = 'S') as double) as debit,
                cast(sum(amount) filter (where debit_credit_indicator = 'H') as double) as credit,
                count(*) as lines,
                count(*) filter (where debit_credit_indicator = 'S') as debit_lines,
                count(*) filter (where debit_credit_indicator = 'H') as credit_lines,
                count(distinct transaction_type) as categories,
                string_agg(distinct currency, ',' order by currency) as currencies from ({REVENUE})""",
        ),
        "ledger_currencies": case(
            _on("fact_revenue", r.ledger_currencies), _group(REVENUE, "currency", f"{AMOUNT}, count(*) as lines")
        ),
        "ledger_trend": case(
            _on("fact_revenue", r.ledger_trend), _group(REVENUE, "posting_date", AMOUNT), dates=("posting_date",)
        ),
        "ledger_by_period": case(
            _on("fact_revenue", r.ledger_by_period), _group(REVENUE, "fiscal_period", AMOUNT)
        ),
        "ledger_top_accounts": case(
            _on("fact_revenue", r.ledger_top_accounts),
            _top(_group(REVENUE, "gl_account", AMOUNT), "amount", "gl_account"),
        ),
        "fertilizer_kpis": case(
            _on("fact_fertilizer", r.fertilizer_kpis),
            f"""select {QTY}, count(*) as applications, count(distinct material_id) as materials,
                count(distinct block_id) as blocks, {_mean('quantity_kg', 'avg_kg')} from ({FERTILIZER})""",
        ),
        "fertilizer_trend": case(
            _on("fact_fertilizer", r.fertilizer_trend),
            _group(FERTILIZER, "application_date", QTY),
            dates=("application_date",),
        ),
        "fertilizer_top_blocks": case(
            _on("fact_fertilizer", r.fertilizer_top_blocks),
            _top(_group(FERTILIZER, "block_id", QTY), "kg", "block_id"),
        ),
        "fleet_by_type": case(
            _on("dim_equipment", r.fleet_by_type), _group(FLEET, "equipment_type", "count(*) as machines", True)
        ),
        "equipment_kpis": case(
            _equipment,
            f"""select count(*) as operations, count(distinct equipment_id) as machines_used,
                {_sum('fuel_consumption_liters', 'liters')},
                count(*) filter (where maintenance_flag) as maintenance_operations,
                (select count(*) from ({FLEET})) as fleet from ({OPERATIONS})""",
        ),
        "operations_by_status": case(
            _on("fact_equipment", r.operations_by_status),
            _group(OPERATIONS, "status", "count(operation_type) as operations"),
        ),
        "fuel_trend": case(
            _on("fact_equipment", r.fuel_trend),
            _group(OPERATIONS, "operation_date", _sum("fuel_consumption_liters", "liters")),
            dates=("operation_date",),
        ),
        "minutes_by_type": case(
            _on("fact_equipment", r.minutes_by_type), _group(OPERATIONS, "equipment_type", MINUTES)
        ),
        "top_machines": case(
            _on("fact_equipment", r.top_machines),
            _top(_group(OPERATIONS, "equipment_id", MINUTES), "minutes", "equipment_id"),
        ),
        "workforce": case(_on("dim_employee", r.workforce), WORKFORCE),
        "workforce_kpis": case(
            _on("dim_employee", r.workforce_kpis),
            f"""select cast(sum(people) as bigint) as people, count(distinct role) as roles,
                count(distinct department) as departments, count(distinct cost_center_id) as cost_centers
                from ({WORKFORCE})""",
        ),
        "live_status": case(_live(r.live_status), STATUS, times=("last_reading_ts",)),
        "live_last_status": case(
            _live(r.live_status, last_status=True),
            LAST_STATUS,
            times=("last_reading_ts",),
        ),
        "live_kpis": case(
            _live(r.live_kpis),
            f"""with readings as ({READINGS}),
                per_sensor as (select block_id, sensor_id, avg(battery_level_pct) as level from readings group by all)
                select count(distinct sensor_id) as sensors, count(*) as readings,
                count(*) filter (where sensor_status = 'OK') as ok,
                count(*) filter (where sensor_status = 'ANOMALY') as anomaly,
                count(*) filter (where sensor_status = 'FAULT') as fault,
                (select avg(level) from per_sensor) as mean_of_sensor_means,
                {_mean('battery_level_pct', 'mean_of_readings')} from readings""",
            rounded=("mean_of_sensor_means",),
        ),
        "live_health": case(
            _live(r.live_health),
            " union all ".join(
                f"select '{s}' as sensor_status, count(*) filter (where sensor_status = '{s}') as readings from ({READINGS})"
                for s in ("OK", "ANOMALY", "FAULT")
            ),
        ),
    }
    for column in ("block_id", "crop_type"):
        found[f"harvest_choices_{column}"] = case(
            _on("fact_harvest", r.harvest_choices, column), f"select distinct {column} from ({HARVEST})"
        )
    for column in ("crop_type", "block_id", "destination"):
        found[f"harvest_by_{column}"] = case(
            _on("fact_harvest", r.harvest_by, column), _group(HARVEST, column, KG)
        )
    for column in ("transaction_type", "cost_center_id"):
        found[f"ledger_by_{column}"] = case(
            _on("fact_revenue", r.ledger_by, column), _group(REVENUE, column, AMOUNT)
        )
    for column in ("material_id", "application_method", "crop_type"):
        found[f"fertilizer_by_{column}"] = case(
            _on("fact_fertilizer", r.fertilizer_by, column), _group(FERTILIZER, column, QTY)
        )
    for column in ("role", "department"):
        found[f"workforce_by_{column}"] = case(
            _on("dim_employee", r.workforce_by, column),
            _group(f"select * from ({WORKFORCE})", column, "cast(sum(people) as bigint) as people"),
        )
    for view, measures in r.LIVE_VIEWS.items():
        found[f"live_{view}"] = case(
            _live(r.live_measures, view),
            f"""select block_id, sensor_id, "timestamp" as reading_ts, {', '.join(measures)} from ({READINGS})""",
            times=("reading_ts",),
        )
        for measure in measures:
            found[f"live_series_{measure}"] = case(
                _live(r.live_series, measure),
                f"""select "timestamp" as reading_ts, sensor_id, {measure} from ({READINGS})""",
                times=("reading_ts",),
            )
    for measure in ("soil_moisture_pct", "air_temperature_c"):
        found[f"live_chart_{measure}"] = case(
            _live(r.reduced_series, measure, *STRETCH, WIDTH), _reduced_sql(measure), times=("reading_ts",)
        )
    return found
