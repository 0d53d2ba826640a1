"""Lookups, the active workforce and the ledger."""

from pyspark.sql import functions as F

from catalogue.case import case, silver
from catalogue.raw import load
from catalogue.silver_sql import silver_sql
from fieldlake.operators.ledger import document_balances, posting_reason, unbalanced_documents, unposted_events
from fieldlake.operators.lookup import heavy_keys, hot_keys, keep_members, lookup
from fieldlake.plans.derive import (
    active_attendance,
    active_workers,
    attendance_conflicts,
    enrich_fixed_hour,
    enrich_hourly,
    events,
    fertilizer_use,
    fleet_costs,
    harvest_labor,
    ledger,
    wages,
    with_cost_center,
    with_station,
    with_unit_cost,
)

# Master data, derived from the given small tables by SQL that both engines read.
MASTER = {
    "blocks": """
        select 'BLK' || lpad(cast(n_nationkey as string), 2, '0') as id, 'Tea' as crop_type, 100.0 as area_ha,
          case n_regionkey when 0 then 'REG-NORTH' when 1 then 'REG-CENTRAL' when 2 then 'REG-SOUTH'
            when 3 then 'REG-EAST' else 'REG-NORTH' end as region_id
        from {nation}""",
    "cost_centers": """
        select 'CC10' || cast(r_regionkey as string) as id,
          case r_regionkey when 0 then 'REG-NORTH' when 1 then 'REG-CENTRAL' when 2 then 'REG-SOUTH'
            when 3 then 'REG-CENTRAL' else 'REG-WEST' end as region_id,
          r_regionkey as position
        from {region}""",
    "stations": """
        select 'STN-HOME-' || cast(r_regionkey as string) as station_id,
          case r_regionkey when 0 then 'REG-NORTH' when 1 then 'REG-CENTRAL' when 2 then 'REG-SOUTH'
            else 'REG-FAR-' || cast(r_regionkey as string) end as region_id
        from {region}""",
    "materials": """
        select 'MAT0' || cast(p_partkey + 2 as string) as id, p_type as category, p_size / 4.0 as standard_cost
        from {part}""",
}

_TABLES = ("nation", "region", "part")


def master(spark, sf):
    tables = {table: load(spark, sf, table) for table in _TABLES}
    return {
        name: spark.sql(text, **{t: df for t, df in tables.items() if f"{{{t}}}" in text})
        for name, text in MASTER.items()
    }


def master_sql(name):
    return MASTER[name].format(**{table: table for table in _TABLES})


def _with(**parts):
    return "with " + ", ".join(f"{name} as ({sql})" for name, sql in parts.items()) + " "


def _place(df, blocks):
    return lookup(df, blocks.select(F.col("id").alias("_id"), "region_id"), {"block_id": "_id"}, {"region_id": "REG-NORTH"})


def operations_with_region(spark, sf):
    rows = silver(spark, sf, "equipment").select("operation_id", "timestamp", "block_id")
    return _place(rows, master(spark, sf)["blocks"])


PLACED = """select operation_id, e."timestamp", block_id, coalesce(b.region_id, 'REG-NORTH') as region_id
    from equipment e left join blocks b on b.id = e.block_id"""
LAST_STATION = """select * from (select *, row_number() over (partition by "timestamp", region_id
    order by station_id desc) as rank_in_key from weather) where rank_in_key = 1"""

ENRICH_PARTS = {
    "equipment": silver_sql("equipment"),
    "weather": silver_sql("weather"),
    "blocks": master_sql("blocks"),
    "placed": PLACED,
    "hourly": LAST_STATION,
}

HOURLY_SQL = (
    _with(**ENRICH_PARTS)
    + """select operation_id, p."timestamp", block_id, p.region_id, coalesce(h.rainfall_mm, 0.0) as rainfall_mm,
    coalesce(h.weather_condition, 'Clear') as weather_condition
    from placed p left join hourly h on h."timestamp" = date_trunc('hour', p."timestamp") and h.region_id = p.region_id"""
)

STATION_SQL = (
    _with(**ENRICH_PARTS, stations=master_sql("stations"))
    + """select operation_id, p."timestamp", block_id, p.region_id, coalesce(h.rainfall_mm, 0.0) as rainfall_mm,
    coalesce(h.weather_condition, 'Clear') as weather_condition,
    coalesce(h.station_id, s.station_id, 'STN-NORTH') as station_id
    from placed p left join hourly h on h."timestamp" = date_trunc('hour', p."timestamp") and h.region_id = p.region_id
    left join stations s on s.region_id = p.region_id"""
)


def fixed_hour(spark, sf):
    centers = master(spark, sf)["cost_centers"].select(F.col("id").alias("_id"), "region_id")
    days = silver(spark, sf, "hr").select("attendance_id", "attendance_date", "cost_center_id")
    placed = lookup(days, centers, {"cost_center_id": "_id"}, {"region_id": "REG-NORTH"})
    return enrich_fixed_hour(placed, silver(spark, sf, "weather"), "attendance_date")


FIXED_HOUR_SQL = (
    _with(
        hr=silver_sql("hr"),
        weather=silver_sql("weather"),
        centers=master_sql("cost_centers"),
        hourly=LAST_STATION,
        placed="""select attendance_id, attendance_date, cost_center_id, coalesce(c.region_id, 'REG-NORTH') as region_id
            from hr left join centers c on c.id = cost_center_id""",
    )
    + """select attendance_id, attendance_date, cost_center_id, p.region_id,
    coalesce(h.rainfall_mm, 0.0) as rainfall_mm, coalesce(h.weather_condition, 'Clear') as weather_condition
    from placed p left join hourly h on h."timestamp" = cast(attendance_date as timestamp) + interval 8 hour
    and h.region_id = p.region_id"""
)

LAST_CENTER = """select region_id, arg_max(id, position) as cost_center_id from cost_centers group by region_id"""
CENTERS = {
    "blocks": master_sql("blocks"),
    "cost_centers": master_sql("cost_centers"),
    "last_center": LAST_CENTER,
}


def _center_sql(rows, columns):
    return f"""select {columns}, coalesce(b.region_id, 'REG-NORTH') as region_id,
      coalesce(c.cost_center_id, 'CC101') as cost_center_id
      from ({rows}) f left join blocks b on b.id = f.block_id
      left join last_center c on c.region_id = coalesce(b.region_id, 'REG-NORTH')"""


def cost_center_chain(spark, sf):
    tables = master(spark, sf)
    rows = silver(spark, sf, "harvest").select("harvest_id", "block_id")
    return with_cost_center(rows, tables["blocks"], tables["cost_centers"])


def unit_cost(spark, sf):
    rows = silver(spark, sf, "fertilizer").select("application_id", "material_id", "quantity_kg")
    return with_unit_cost(rows, master(spark, sf)["materials"])


ACTIVE_SQL = """select distinct cast("timestamp" as date) as work_date, employee_id from harvest
    where status is distinct from 'CANCELLED' and length(employee_id) > 0
    union select distinct cast("timestamp" as date), operator_id from equipment
    where status is distinct from 'BREAKDOWN' and status is distinct from 'IDLE' and length(operator_id) > 0"""
ACTIVE_PARTS = {"harvest": silver_sql("harvest"), "equipment": silver_sql("equipment"), "active": ACTIVE_SQL}


def active(spark, sf):
    return active_workers(silver(spark, sf, "harvest"), silver(spark, sf, "equipment"))


def _attendance(spark, sf):
    return silver(spark, sf, "hr").select("attendance_id", "employee_id", "attendance_date", "attendance_status")


ATTENDED_SQL = """select attendance_id, employee_id, attendance_date, attendance_status from hr
    where exists (select 1 from active a where a.work_date = attendance_date and a.employee_id = hr.employee_id)"""


def _posting(kind, table, accounts, reference, text, amount, employee, equipment, material, center, posted, condition="true"):
    debit, credit = accounts
    return f"""select {posted} as posting_timestamp, {center} as cost_center_id, '{debit}' as debit_account,
      '{credit}' as credit_account, '{kind}' as transaction_type, {reference} as reference_document,
      {employee} as employee_id, {equipment} as equipment_id, {material} as material_id, {amount} as amount,
      '{text} ' || {reference} as description from {table} where {condition}"""


_NOTHING = "cast(null as string)"


def _exact(column):
    return f"cast({column} as decimal(18,4))"


LABOR_SQL = _posting(
    "HARVEST_LABOR",
    f"({_center_sql('select * from harvest', 'f.*')})",
    ("500100", "200100"),
    "harvest_id",
    "Harvest Labor Batch",
    f"{_exact('harvested_weight_kg')} * 0.08 + 7.5",
    "employee_id",
    "equipment_id",
    _NOTHING,
    "cost_center_id",
    '"timestamp"',
    "status is distinct from 'CANCELLED'",
)
FERTILIZER_SQL = _posting(
    "FERTILIZER_CONSUMPTION",
    f"""(select c.*, coalesce(m.standard_cost, 2.5) as unit_cost from ({_center_sql('select * from fertilizer', 'f.*')}) c
        left join materials m on m.id = c.material_id)""",
    ("501100", "140100"),
    "application_id",
    "Fertilizer Consumption",
    f"{_exact('quantity_kg')} * {_exact('unit_cost')}",
    "employee_id",
    "equipment_id",
    "material_id",
    "cost_center_id",
    '"timestamp"',
    "application_status is distinct from 'CANCELLED'",
)
FLEET_SQL = (
    _posting(
        "EQUIPMENT_FUEL",
        "equipment",
        ("502100", "140100"),
        "operation_id",
        "Equipment Fuel",
        f"{_exact('fuel_consumption_liters')} * 1.20",
        "operator_id",
        "equipment_id",
        "'MAT04'",
        "'CC201'",
        '"timestamp"',
    )
    + " union all "
    + _posting(
        "EQUIPMENT_MAINTENANCE",
        "equipment",
        ("502200", "200100"),
        "operation_id",
        "Equipment Repair",
        "250.00",
        "operator_id",
        "equipment_id",
        _NOTHING,
        "'CC201'",
        '"timestamp"',
        "maintenance_flag",
    )
)
_WORKED = "attendance_status in ('PRESENT', 'LATE')"
_WAGE = ("employee_id", _NOTHING, _NOTHING, "coalesce(cost_center_id, 'CC101')")
_EVENING = "cast(attendance_date as timestamp) + interval 17 hour"
WAGES_SQL = (
    _posting(
        "PAYROLL_WAGES",
        "hr",
        ("503100", "200100"),
        "attendance_id",
        "Daily Wage",
        f"{_exact('working_hours')} * 12.50",
        *_WAGE,
        _EVENING,
        _WORKED,
    )
    + " union all "
    + _posting(
        "OVERTIME_WAGES",
        "hr",
        ("503200", "200100"),
        "attendance_id",
        "Overtime Wages",
        f"{_exact('overtime_hours')} * 18.75",
        *_WAGE,
        _EVENING,
        _WORKED,
    )
)
_SIDE = """select 'DOC-' || transaction_type || '-' || reference_document as document_id,
    cast(posting_timestamp as date) as posting_date, posting_timestamp,
    cast(year(posting_timestamp) as int) as fiscal_year, cast(month(posting_timestamp) as int) as fiscal_period,
    'MY10' as company_code, cost_center_id, {account} as gl_account, transaction_type, reference_document,
    employee_id, equipment_id, material_id, cast(round_even(amount, 2) as decimal(18,2)) as amount,
    'MYR' as currency, '{side}' as debit_credit_indicator, '{label}: ' || description as description
    from events_posted where amount > 0"""
LEDGER_PARTS = {
    "harvest": silver_sql("harvest"),
    "fertilizer": silver_sql("fertilizer"),
    "equipment": silver_sql("equipment"),
    "hr": silver_sql("hr"),
    **CENTERS,
    "materials": master_sql("materials"),
}
PAIR = _SIDE.format(account="debit_account", side="S", label="Debit") + " union all " + _SIDE.format(
    account="credit_account", side="H", label="Credit"
)


def _posted(events_sql):
    """Amounts are brought to one decimal type first, as the parts of a union may differ."""
    exact = f"select * replace (cast(amount as decimal(38,8)) as amount) from ({events_sql})"
    return _with(**LEDGER_PARTS, events_posted=exact)


ALL_EVENTS = " union all ".join(
    f"select * replace (cast(amount as decimal(38,8)) as amount) from ({sql})"
    for sql in (LABOR_SQL, FERTILIZER_SQL, FLEET_SQL.split(" union all ")[0], FLEET_SQL.split(" union all ")[1],
                WAGES_SQL.split(" union all ")[0], WAGES_SQL.split(" union all ")[1])
)
LEDGER_SQL = _posted(ALL_EVENTS) + PAIR


def whole_ledger(spark, sf):
    sources = {name: silver(spark, sf, name) for name in ("harvest", "fertilizer", "equipment", "hr")}
    return ledger(sources, master(spark, sf), fee="7.50")


def events_without_posting(spark, sf):
    sources = {name: silver(spark, sf, name) for name in ("harvest", "fertilizer", "equipment", "hr")}
    every = events(sources, master(spark, sf), fee="7.50")
    left = unposted_events(every).groupBy("transaction_type", "reason").agg(F.count("*").alias("events"))
    posted = every.where(posting_reason().isNull()).groupBy("transaction_type").agg(F.count("*").alias("events"))
    return left.unionByName(posted.withColumn("reason", F.lit("posted")))


UNPOSTED_SQL = _posted(ALL_EVENTS) + """select transaction_type,
    case when amount is null then 'no amount' when amount <= 0 then 'not positive'
         when abs(amount) >= 1e16 then 'beyond money' else 'posted' end as reason,
    count(*) as events from events_posted group by all"""


BALANCE_SQL = f"""select *, debit_lines = 1 and credit_lines = 1 and lines = 2 and debit = credit as balanced from (
    select document_id, count(*) filter (where debit_credit_indicator = 'S') as debit_lines,
    count(*) filter (where debit_credit_indicator = 'H') as credit_lines, count(*) as lines,
    coalesce(sum(amount) filter (where debit_credit_indicator = 'S'), 0) as debit,
    coalesce(sum(amount) filter (where debit_credit_indicator = 'H'), 0) as credit
    from ({silver_sql('finance')}) group by document_id)"""


def _rule(build, events_sql):
    sql = "select * replace (cast(amount as decimal(38,8)) as amount) from "
    parts = " union all ".join(f"{sql}({part})" for part in events_sql.split(" union all "))
    return case(build, _with(**LEDGER_PARTS) + parts, times=("posting_timestamp",), decimals=("amount",))


def _labor(spark, sf):
    tables = master(spark, sf)
    return harvest_labor(silver(spark, sf, "harvest"), tables["blocks"], tables["cost_centers"], "7.50")


def _fertilizer(spark, sf):
    tables = master(spark, sf)
    rows = silver(spark, sf, "fertilizer")
    return fertilizer_use(rows, tables["blocks"], tables["cost_centers"], tables["materials"])


def _lines_with_order(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = load(spark, sf, "orders")
    return lookup(lines, orders, {"l_orderkey": "o_orderkey"}, {"o_orderpriority": "NONE", "o_custkey": None})


def _lines_with_supplier(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    suppliers = load(spark, sf, "supplier")
    hot = hot_keys(lines, ["l_suppkey"], 1_000)
    return lookup(lines, suppliers, {"l_suppkey": "s_suppkey"}, {"s_name": "NOBODY"}, hot=hot)


# A third of the lines at one place, others at few, many at places of their own, some at none.
SKEWED = """case when l_returnflag = 'R' then 0 when l_linenumber = 7 then -1 when l_linenumber = 6 then -l_suppkey % 30 - 2
    when l_linenumber = 5 then null else l_orderkey end"""


def _skewed_lines(spark, sf):
    return load(spark, sf, "lineitem").withColumn("place", F.expr(SKEWED))


def cases():
    return {
        "enrich_hourly": case(
            lambda spark, sf: enrich_hourly(operations_with_region(spark, sf), silver(spark, sf, "weather")),
            HOURLY_SQL,
            times=("timestamp",),
        ),
        "enrich_station": case(
            lambda spark, sf: with_station(
                operations_with_region(spark, sf), silver(spark, sf, "weather"), master(spark, sf)["stations"]
            ),
            STATION_SQL,
            times=("timestamp",),
        ),
        "enrich_fixed_hour": case(fixed_hour, FIXED_HOUR_SQL, dates=("attendance_date",)),
        "cost_center_chain": case(
            cost_center_chain,
            _with(**CENTERS) + _center_sql(silver_sql("harvest"), "harvest_id, block_id"),
        ),
        "unit_cost_default": case(
            unit_cost,
            f"""select application_id, material_id, quantity_kg, cast(coalesce(m.standard_cost, 2.5) as double)
                as standard_cost from ({silver_sql('fertilizer')}) left join ({master_sql('materials')}) m
                on m.id = material_id""",
        ),
        "lookup_shuffled": case(
            _lines_with_order,
            """select l_orderkey, l_linenumber, l_partkey, l_quantity,
               coalesce(o_orderpriority, 'NONE') as o_orderpriority, o_custkey
               from lineitem left join orders on o_orderkey = l_orderkey""",
        ),
        "lookup_hot_keys": case(
            _lines_with_supplier,
            """select l_orderkey, l_linenumber, l_suppkey, l_partkey, coalesce(s_name, 'NOBODY') as s_name
               from lineitem left join supplier on s_suppkey = l_suppkey""",
        ),
        "unposted_events": case(events_without_posting, UNPOSTED_SQL),
        "heavy_keys": case(
            lambda spark, sf: heavy_keys(_skewed_lines(spark, sf), ["place", "l_linestatus"], 50),
            f"""select place, l_linestatus from (select *, {SKEWED} as place from lineitem)
               where place is not null and l_linestatus is not null group by all
               having count(*) * 50 > (select count(*) from lineitem where {SKEWED} is not null and l_linestatus is not null)""",
        ),
        "hot_keys": case(
            lambda spark, sf: hot_keys(load(spark, sf, "events"), ["event_type"], 5),
            """select event_type from events group by 1
               having count(*) * 5 > (select count(*) from events)""",
        ),
        "members": case(
            lambda spark, sf: keep_members(
                load(spark, sf, "customer").select("c_custkey", "c_name"),
                load(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"),
                ["c_custkey"],
            ),
            """select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders)""",
        ),
        "active_workers": case(active, _with(**ACTIVE_PARTS) + "select * from active", dates=("work_date",)),
        "active_attendance": case(
            lambda spark, sf: active_attendance(_attendance(spark, sf), active(spark, sf)),
            _with(**ACTIVE_PARTS, hr=silver_sql("hr")) + ATTENDED_SQL,
            dates=("attendance_date",),
        ),
        "attendance_conflicts": case(
            lambda spark, sf: attendance_conflicts(_attendance(spark, sf), active(spark, sf)),
            _with(**ACTIVE_PARTS, hr=silver_sql("hr"))
            + ATTENDED_SQL
            + " and coalesce(attendance_status not in ('PRESENT', 'LATE'), true)",
            dates=("attendance_date",),
        ),
        "postings_harvest_labor": _rule(_labor, LABOR_SQL),
        "postings_fertilizer": _rule(_fertilizer, FERTILIZER_SQL),
        "postings_fleet": case(
            lambda spark, sf: fleet_costs(silver(spark, sf, "equipment")).where("amount is not null"),
            _with(**LEDGER_PARTS)
            + " union all ".join(
                f"select * replace (cast(amount as decimal(38,8)) as amount) from ({part}) where amount is not null"
                for part in FLEET_SQL.split(" union all ")
            ),
            times=("posting_timestamp",),
            decimals=("amount",),
        ),
        "postings_wages": _rule(lambda spark, sf: wages(silver(spark, sf, "hr")), WAGES_SQL),
        "ledger_lines": case(
            whole_ledger,
            LEDGER_SQL,
            dates=("posting_date",),
            times=("posting_timestamp",),
            decimals=("amount",),
        ),
        "ledger_unbalanced": case(
            lambda spark, sf: unbalanced_documents(whole_ledger(spark, sf)),
            "select * from (" + BALANCE_SQL.replace(silver_sql("finance"), LEDGER_SQL) + ") where not balanced",
            decimals=("debit", "credit"),
        ),
        "document_balances": case(
            lambda spark, sf: document_balances(silver(spark, sf, "finance")),
            BALANCE_SQL,
            decimals=("debit", "credit"),
        ),
    }
