"""The estate's raw text sources, derived from the given tables by SQL that both engines read.

The given tables are clean. The projections put back what raw files have: mixed case, stray
spaces, blanks, malformed numbers and times, missing keys and duplicates. They take whole tables.
"""

from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "events", "customer", "part", "supplier", "nation", "region")

_LINE = "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"
_CANCELLED = "l_returnflag = 'R' and l_linestatus = 'O'"

HARVEST = f"""
select
  case when l_orderkey % 101 = 0 then null
       when l_orderkey % 103 = 0 then '   '
       when l_suppkey % 2 = 1 then ' hvt-' || {_LINE} || ' '
       else 'HVT-' || {_LINE} end as harvest_id,
  case when l_orderkey % 97 = 0 then 'bad'
       else substring(cast(l_shipdate as string), 1, 10) || ' ' || lpad(cast(l_linenumber + 5 as string), 2, '0')
            || ':' || lpad(cast(cast(floor(l_quantity) as int) as string), 2, '0') || ':00' end as timestamp,
  ' blk' || lpad(cast(l_suppkey % 40 as string), 2, '0') as block_id,
  case l_partkey % 4 when 0 then 'Oil Palm ' when 1 then 'rubber' when 2 then 'Tea' else null end as crop_type,
  'emp' || cast(l_suppkey as string) as employee_id,
  case when l_linenumber = 1 then '  ' else 'EQP' || cast(l_partkey % 30 as string) || ' ' end as equipment_id,
  case when {_CANCELLED} and l_discount < 0.09 then '0.0'
       when l_partkey % 89 = 0 then 'oops'
       when l_partkey % 83 = 0 then null
       when l_partkey % 79 = 0 then '-1.5'
       else cast(l_extendedprice as string) end as harvested_weight_kg,
  case when {_CANCELLED} then 'reject' when l_discount < 0.03 then 'a' when l_discount < 0.07 then 'b'
       when l_discount < 0.09 then 'c' else null end as quality_grade,
  case when l_tax > 0.07 then cast(l_quantity * 3 as string) else cast(l_quantity as string) end as moisture_pct,
  cast(cast(floor(l_quantity) as int) * 5 as string) as collection_duration_minutes,
  case when {_CANCELLED} and l_tax < 0.07 then 'N/A' when l_linenumber = 7 then ' '
       else 'Mill ' || cast(l_linenumber as string) end as destination,
  case when {_CANCELLED} then 'cancelled' when l_returnflag = 'R' then 'Delayed'
       when l_partkey % 71 = 0 then null else ' completed' end as status
from {{lineitem}}
"""

FERTILIZER = """
select
  case when o_orderkey % 107 = 0 then null else ' fert-' || cast(o_orderkey as string) end as application_id,
  case when o_orderkey % 109 = 0 then '1997-13-01 00:00:00'
       else substring(cast(o_orderdate as string), 1, 10) || 'T' || lpad(cast(o_custkey % 24 as string), 2, '0')
            || ':30:00' end as timestamp,
  'Blk' || lpad(cast(o_custkey % 12 as string), 2, '0') as block_id,
  case o_custkey % 3 when 0 then 'tea' when 1 then 'coffee' else 'rubber' end as crop_type,
  'EMP' || cast(o_custkey % 90 as string) as employee_id,
  'mat' || lpad(cast(o_custkey % 7 as string), 2, '0') as material_id,
  case when o_orderkey % 113 = 0 then '0' when o_orderkey % 127 = 0 then '-5.5'
       else cast(o_totalprice as string) end as quantity_kg,
  o_orderpriority as application_method,
  case when o_custkey % 5 = 0 then '' else 'eqp' || cast(o_custkey % 30 as string) end as equipment_id,
  case when o_custkey % 6 = 0 then '   ' else 'STN-NORTH' end as weather_station_id,
  'Light Rain' as weather_condition,
  case when o_custkey % 4 = 0 then ' ' else cast(o_custkey % 20 as string) || '.5' end as rainfall_mm,
  case o_orderstatus when 'P' then 'CANCELLED' when 'F' then 'completed' else 'delayed ' end as application_status,
  case when o_custkey % 2 = 0 then null
       else ' said "go", then, ' || o_orderpriority || ' ' end as notes
from {orders}
"""

EQUIPMENT = """
select
  'op-' || cast(event_id as string) as operation_id,
  case when event_id % 131 = 0 then '' else cast(ts as string) end as timestamp,
  ' eqp' || cast(user_id as string) as equipment_id,
  case user_id % 6 when 0 then 'tractor' when 1 then 'Harvester' when 2 then 'Sprayer' when 3 then 'Truck'
       when 4 then 'drone' else null end as equipment_type,
  case when user_id % 4 = 0 then ' ' else 'BLK' || lpad(cast(user_id % 14 as string), 2, '0') end as block_id,
  case when user_id % 10 = 9 then '' else 'EMP' || cast(user_id % 90 as string) end as operator_id,
  event_type as operation_type,
  cast(ts as string) as start_time,
  case when event_type = 'error' then 'later' else cast(ts as string) end as end_time,
  cast(cast(floor(value) as int) as string) as duration_minutes,
  cast(value * 2 as string) as engine_hours,
  case when event_type = 'signup' then '0.0' when event_type = 'view' then null
       else cast(value as string) end as fuel_consumption_liters,
  case when user_id % 6 = 4 then '' else cast(user_id as string) || '.25' end as distance_km,
  case event_type when 'error' then 'True' when 'signup' then 'no' else 'False' end as maintenance_flag,
  case when event_type = 'error' then 'Repair' else '   ' end as maintenance_type,
  case event_type when 'error' then 'breakdown' when 'click' then 'idle' when 'view' then 'delayed'
       when 'signup' then null else 'completed' end as status
from {events}
"""

HR = """
select
  case when o_custkey % 2 = 0 then 'att-' else 'ATT-' end || cast(o_orderkey as string) as attendance_id,
  ' emp' || cast(o_custkey % 90 as string) as employee_id,
  ' Worker ' || cast(o_custkey % 90 as string) || ' ' as employee_name,
  case o_custkey % 5 when 0 then ' Harvester' when 1 then 'Driver' when 2 then 'Agronomist' when 3 then 'Technician'
       else null end as role,
  case o_custkey % 3 when 0 then 'Field Operations ' when 1 then 'Logistics' else 'Engineering' end as department,
  case when o_custkey % 11 = 0 then null else 'cc10' || cast(o_custkey % 3 + 1 as string) end as cost_center_id,
  case when o_orderkey % 137 = 0 then '01/02/1997'
       when o_custkey % 2 = 0 then '2024-01-' || lpad(cast(o_orderkey % 30 + 1 as string), 2, '0')
       else substring(cast(o_orderdate as string), 1, 10) end as attendance_date,
  case o_custkey % 2 when 0 then 'Morning Shift' else 'day shift' end as shift,
  case when o_orderstatus = 'P' then ' ' else '07:00' end as check_in_time,
  case when o_orderstatus = 'P' then '' else '16:00' end as check_out_time,
  case when o_orderkey % 139 = 0 then '25' else cast(o_custkey % 9 as string) || '.5' end as working_hours,
  case o_custkey % 4 when 0 then '1.5' when 1 then '0' else '0.0' end as overtime_hours,
  case when o_orderstatus = 'P' then 'absent' when o_custkey % 7 = 0 then 'Late'
       when o_custkey % 13 = 0 then 'ANNUAL_LEAVE' else 'present' end as attendance_status,
  case when o_custkey % 13 = 0 then 'Annual' else ' ' end as leave_type,
  'Field' as work_location,
  '' as remarks
from {orders}
"""

_FINANCE_SIDE = """
select
  case when o_orderkey % 149 = 0 then null else ' doc-' || cast(o_orderkey as string) end as document_id,
  case when o_orderkey % 151 = 0 then 'n/a' else substring(cast(o_orderdate as string), 1, 10) end as posting_date,
  cast(o_orderdate as string) as posting_timestamp,
  substring(cast(o_orderdate as string), 1, 4) as fiscal_year,
  case when o_orderkey % 157 = 0 then '17' else substring(cast(o_orderdate as string), 6, 2) end as fiscal_period,
  'my10' as company_code,
  case when o_custkey % 9 = 0 then null else 'cc10' || cast(o_custkey % 4 as string) end as cost_center_id,
  {account} as gl_account,
  case o_custkey % 3 when 0 then 'harvest_labor' when 1 then 'EQUIPMENT_FUEL' else 'payroll_wages' end
    as transaction_type,
  case when o_custkey % 8 = 0 then ' ' else 'REF-' || cast(o_custkey as string) end as reference_document,
  'EMP' || cast(o_custkey % 90 as string) as employee_id,
  '' as equipment_id,
  ' MAT04 ' as material_id,
  case when o_orderkey % 163 = 0 then 'n/a' when o_orderkey % 167 = 0 then '-12.5'
       else cast(o_totalprice as string) end as amount,
  case when o_custkey % 50 = 0 then 'usd' else ' myr' end as currency,
  '{side}' as debit_credit_indicator,
  '{label}: order ' || cast(o_orderkey as string) as description
from {{orders}}
"""

FINANCE = (
    _FINANCE_SIDE.format(
        account="case when o_orderkey % 173 = 0 then null else '50' || cast(o_custkey % 15 as string) || '00 ' end",
        side="s",
        label="Debit",
    )
    + " union all "
    + _FINANCE_SIDE.format(
        account="case when o_orderkey % 173 = 0 then null else ' 20' || cast(o_custkey % 2 as string) || '100' end",
        side="H ",
        label="Credit",
    )
)

WEATHER = """
select
  substring(cast(ts as string), 1, 13) || ':00:00' as timestamp,
  case when event_id % 179 = 0 then ' ' when event_id % 2 = 0 then 'stn-' || cast(user_id % 4 as string)
       else ' STN-' || cast(user_id % 4 as string) end as station_id,
  case user_id % 4 when 0 then 'reg-north' when 1 then 'REG-CENTRAL' when 2 then 'reg-south ' else 'REG-SOUTH' end
    as region_id,
  case when event_id % 181 = 0 then '51.5' else cast(user_id % 40 as string) end as temperature_c,
  cast(user_id % 105 as string) || '.5' as humidity_pct,
  case when event_type = 'click' then '' else cast(value as string) end as rainfall_mm,
  case when event_type = 'error' then '-1' else '12.5' end as wind_speed_kmh,
  event_type as weather_condition,
  cast(880 + user_id as string) as pressure_hpa
from {events}
"""

SENSORS = """
select
  case when event_id % 191 = 0 then 'soon' else cast(ts as string) end as timestamp,
  ' blk' || lpad(cast(user_id % 10 + 1 as string), 2, '0') as block_id,
  case when event_id % 193 = 0 then '  ' when event_id % 2 = 0 then 'sns' || cast(user_id as string)
       else ' SNS' || cast(user_id as string) || ' ' end as sensor_id,
  cast(value as string) as soil_moisture_pct,
  ' ' || cast(user_id % 35 as string) || '.5' as soil_temperature_c,
  case when event_type = 'click' then '   ' else cast(value / 4 as string) end as air_temperature_c,
  case when event_type = 'view' then 'oops' else cast(user_id % 100 as string) end as humidity_pct,
  cast(user_id % 14 as string) as soil_ph,
  cast(event_id as string) as light_intensity_lux,
  case when event_type = 'signup' then '' else cast(user_id % 101 as string) || '.25' end as battery_level_pct,
  case event_type when 'error' then 'fault' when 'click' then 'Anomaly ' when 'view' then null else 'ok' end
    as sensor_status
from {events}
"""

RAW = {
    "weather": WEATHER,
    "harvest": HARVEST,
    "fertilizer": FERTILIZER,
    "equipment": EQUIPMENT,
    "hr": HR,
    "finance": FINANCE,
    "sensors": SENSORS,
}


def load(spark, sf_dir, table):
    """A given table. Its times have no zone; they are read as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    naive = {name: df[name].cast("timestamp") for name, kind in df.dtypes if kind == "timestamp_ntz"}
    return df.withColumns(naive) if naive else df


def raw_source(spark, sf_dir, name):
    """A raw source as a DataFrame of text.

    Each row's text is made once, as if it were read from a file: the generator keeps the optimizer
    from copying these projections into every filter on them.
    """
    text = RAW[name]
    frames = {table: load(spark, sf_dir, table) for table in TABLES if f"{{{table}}}" in text}
    rows = spark.sql(text, **frames)
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def raw_sql(name):
    """The same source as SQL over the given tables."""
    return RAW[name].format(**{table: table for table in TABLES})
