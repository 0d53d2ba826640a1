"""Cleaning, filters, keys and typed tables."""

from pyspark.sql import functions as F

from catalogue.case import CONTRACTS, case, gold, silver
from catalogue.raw import load, raw_source, raw_sql
from catalogue.silver_sql import CLEAN, KEYS, REQUIRED, blank, clean_sql, day, model_sql, num, one_per_key, silver_sql, when
from fieldlake.functions.measures import hour_of, outside
from fieldlake.functions.parsing import to_type
from fieldlake.operators.cleaning import clean_rows, drop_null_keys, nullify_blanks, parse_losses, standardize
from fieldlake.operators.conform import apply_contract, text_widths
from fieldlake.operators.dedupe import dedupe, duplicate_counts
from fieldlake.operators.measures import filter_in, first_rows, is_not
from fieldlake.operators.quality import implication_check
from fieldlake.plans.estate import SERVING

TIMES = {
    "weather": ("timestamp",),
    "harvest": ("timestamp",),
    "fertilizer": ("timestamp",),
    "equipment": ("timestamp", "start_time", "end_time"),
    "hr": (),
    "finance": ("posting_timestamp",),
    "sensors": ("timestamp",),
}
DATES = {"hr": ("attendance_date",), "finance": ("posting_date",)}


def _raw(source):
    return lambda spark, sf: raw_source(spark, sf, source)


def blank_to_null(spark, sf):
    df = raw_source(spark, sf, "fertilizer").select("application_id", "equipment_id", "weather_station_id", "notes")
    return nullify_blanks(df, ["equipment_id", "weather_station_id", "notes", "no_such_column"])


def standard_text(spark, sf):
    df = raw_source(spark, sf, "hr").select("attendance_id", "employee_id", "employee_name", "role", "shift")
    return standardize(df, codes=["attendance_id", "employee_id", "shift"], trims=["employee_name", "role"])


def parsed_times(spark, sf):
    df = raw_source(spark, sf, "finance")
    return df.select(
        "document_id",
        to_type(F.col("posting_date"), "string", "date").alias("posting_date"),
        to_type(F.col("posting_timestamp"), "string", "timestamp").alias("posting_timestamp"),
        F.to_date(to_type(F.col("posting_timestamp"), "string", "timestamp")).alias("derived_date"),
    )


def parsed_numbers(spark, sf):
    harvest = raw_source(spark, sf, "harvest")
    return harvest.select(
        "harvest_id",
        to_type(F.col("harvested_weight_kg"), "string", "double").alias("kg"),
        to_type(F.col("harvested_weight_kg"), "string", "decimal(18,2)").alias("kg_exact"),
        to_type(F.col("collection_duration_minutes"), "string", "int").alias("minutes"),
    )


def parsed_flags(spark, sf):
    df = raw_source(spark, sf, "equipment")
    return df.select("operation_id", to_type(F.col("maintenance_flag"), "string", "boolean").alias("maintenance_flag"))


def losses(source):
    typed = {name: kind for name, kind in CONTRACTS[source].clean_types.items() if kind != "string"}
    sql = " union all ".join(
        f"""select '{name}' as column_name, count(*) filter
            (where {blank(name)} is not null and ({CLEAN[source][name]}) is null) as lost_values
            from ({raw_sql(source)})"""
        for name in typed
    )
    return case(lambda spark, sf: parse_losses(raw_source(spark, sf, source), CONTRACTS[source]), sql)


def keyed_rows(blank_key_is_null):
    """Rows left after the key filter; blank keys are dropped or kept."""

    def run(spark, sf):
        rows = clean_rows(raw_source(spark, sf, "harvest"), CONTRACTS["harvest"], blank_key_is_null)
        return rows.groupBy("harvest_id").agg(F.count(F.lit(1)).alias("copies"))

    key = "nullif(upper(trim(harvest_id)), '')" if blank_key_is_null else "upper(trim(harvest_id))"
    sql = f"""select {key} as harvest_id, count(*) as copies from ({raw_sql('harvest')})
      where {key} is not null and {when('timestamp')} is not null group by 1"""
    return case(run, sql)


def null_keys_dropped(spark, sf):
    return drop_null_keys(raw_source(spark, sf, "finance"), ["document_id", "gl_account"]).select(
        "document_id", "gl_account", "debit_credit_indicator"
    )


LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def calendar(spark, sf):
    ts = F.col("ts")
    return load(spark, sf, "events").select(
        "event_id",
        hour_of(ts).alias("event_hour"),
        F.to_date(ts).alias("event_date"),
        F.year(ts).alias("fiscal_year"),
        F.month(ts).alias("fiscal_period"),
        F.when(F.col("event_type") == "error", "FAULT").when(F.col("value") > 100, "HIGH").otherwise("OK").alias("label"),
    )


def ranges(source):
    rules = CONTRACTS[source].ranges

    def run(spark, sf):
        rows = clean_rows(raw_source(spark, sf, source), CONTRACTS[source])
        counts = [F.count_if(outside(F.col(r.column), r.low, r.high)).alias(r.column) for r in rules]
        return rows.agg(*counts)

    def breaks(rule):
        sides = [f'"{rule.column}" < {rule.low}'] if rule.low is not None else []
        sides += [f'"{rule.column}" > {rule.high}'] if rule.high is not None else []
        return " or ".join(sides)

    listed = ", ".join(f'count(*) filter (where {breaks(r)}) as "{r.column}"' for r in rules)
    condition = " and ".join(f'"{name}" is not null' for name in REQUIRED[source])
    return case(run, f"select {listed} from ({clean_sql(source)}) where {condition}")


def sentinel(spark, sf):
    return implication_check(
        silver(spark, sf, "harvest"),
        F.col("status") == "CANCELLED",
        {
            "weight": F.col("harvested_weight_kg") == 0,
            "destination": F.col("destination") == "N/A",
            "grade": F.col("quality_grade") == "REJECT",
        },
    )


SENTINEL_SQL = " union all ".join(
    f"""select '{name}' as rule, count(*) filter (where status = 'CANCELLED') as rows,
        count(*) filter (where status = 'CANCELLED' and not coalesce({rule}, false)) as broken
        from ({silver_sql('harvest')})"""
    for name, rule in {
        "weight": "harvested_weight_kg = 0",
        "destination": "destination = 'N/A'",
        "grade": "quality_grade = 'REJECT'",
    }.items()
)


def _typed(model):
    contract = SERVING[model]
    dates = tuple(name for name, kind in contract.columns.items() if kind == "date")
    times = tuple(name for name, kind in contract.columns.items() if kind == "datetime2")
    decimals = tuple(name for name, kind in contract.columns.items() if kind.startswith("decimal"))
    return case(
        lambda spark, sf: apply_contract(gold(spark, sf, model), contract),
        model_sql(model),
        dates=dates,
        times=times,
        decimals=decimals,
    )


def _widths_sql(model):
    widths = {n: k[8:-1] for n, k in SERVING[model].columns.items() if k.startswith("varchar")}
    return " union all ".join(
        f"""select '{name}' as column_name, cast(max(length("{name}")) as int) as longest,
            cast({width} as int) as allowed from ({model_sql(model)})"""
        for name, width in widths.items()
    )


def cases():
    found = {
        "blank_to_null": case(
            blank_to_null,
            f"""select application_id, {blank('equipment_id')} as equipment_id,
                {blank('weather_station_id')} as weather_station_id, {blank('notes')} as notes
                from ({raw_sql('fertilizer')})""",
        ),
        "standard_text": case(
            standard_text,
            f"""select upper(trim(attendance_id)) as attendance_id, upper(trim(employee_id)) as employee_id,
                trim(employee_name) as employee_name, trim(role) as role, upper(trim(shift)) as shift
                from ({raw_sql('hr')})""",
        ),
        "parsed_times": case(
            parsed_times,
            f"""select document_id, {day('posting_date')} as posting_date,
                {when('posting_timestamp')} as posting_timestamp,
                cast({when('posting_timestamp')} as date) as derived_date from ({raw_sql('finance')})""",
            dates=("posting_date", "derived_date"),
            times=("posting_timestamp",),
        ),
        "parsed_numbers": case(
            parsed_numbers,
            f"""select harvest_id, {num('harvested_weight_kg')} as kg,
                {num('harvested_weight_kg', 'decimal(18,2)')} as kg_exact,
                {num('collection_duration_minutes', 'int')} as minutes from ({raw_sql('harvest')})""",
            decimals=("kg_exact",),
        ),
        "parsed_flags": case(
            parsed_flags,
            f"select operation_id, {CLEAN['equipment']['maintenance_flag']} as maintenance_flag from ({raw_sql('equipment')})",
        ),
        "blank_keys_dropped": keyed_rows(True),
        "blank_keys_kept": keyed_rows(False),
        "null_keys_dropped": case(
            null_keys_dropped,
            f"""select document_id, gl_account, debit_credit_indicator from ({raw_sql('finance')})
                where document_id is not null and gl_account is not null""",
        ),
        "dedupe_lines": case(
            lambda spark, sf: dedupe(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
            one_per_key("select * from lineitem", ("l_orderkey", "l_linenumber"), list(LINE_COLUMNS)),
            times=("l_shipdate",),
        ),
        "duplicate_keys": case(
            lambda spark, sf: duplicate_counts(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
            """select count(*) as total_rows, count(distinct (l_orderkey, l_linenumber)) as distinct_keys,
               count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicate_rows from lineitem""",
        ),
        "duplicate_null_keys": case(
            lambda spark, sf: duplicate_counts(raw_source(spark, sf, "finance"), ["document_id", "gl_account"]),
            f"""select cast(sum(n) as bigint) as total_rows, count(*) as distinct_keys,
                cast(sum(n) - count(*) as bigint) as duplicate_rows
                from (select count(*) as n from ({raw_sql('finance')}) group by document_id, gl_account)""",
        ),
        "duplicate_rows": case(
            lambda spark, sf: duplicate_counts(raw_source(spark, sf, "weather")),
            f"""select cast(sum(n) as bigint) as total_rows, count(*) as distinct_keys,
                cast(sum(n) - count(*) as bigint) as duplicate_rows
                from (select *, count(*) as n from ({raw_sql('weather')}) group by all)""",
        ),
        "chosen_values": case(
            lambda spark, sf: filter_in(
                load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"),
                {"l_returnflag": ["A", "N"], "l_linestatus": ["O"]},
            ),
            """select l_orderkey, l_returnflag, l_linestatus from lineitem
               where l_returnflag in ('A', 'N') and l_linestatus in ('O')""",
        ),
        "no_choice": case(
            lambda spark, sf: filter_in(
                load(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), {"l_returnflag": []}
            ),
            "select l_orderkey, l_returnflag from lineitem",
        ),
        "status_equals": case(
            lambda spark, sf: silver(spark, sf, "equipment").where("maintenance_flag").select("operation_id", "status"),
            f"select operation_id, status from ({silver_sql('equipment')}) where maintenance_flag",
        ),
        "status_is_not": case(
            lambda spark, sf: silver(spark, sf, "harvest").where(is_not("status", "CANCELLED", "DELAYED")).select(
                "harvest_id", "status"
            ),
            f"""select harvest_id, status from ({silver_sql('harvest')})
                where status is distinct from 'CANCELLED' and status is distinct from 'DELAYED'""",
        ),
        "positive_amounts": case(
            lambda spark, sf: silver(spark, sf, "finance").where(F.col("amount") > 0).select("document_id", "amount"),
            f"select document_id, amount from ({silver_sql('finance')}) where amount > 0",
            decimals=("amount",),
        ),
        "calendar_columns": case(
            calendar,
            """select event_id, date_trunc('hour', ts) as event_hour, cast(ts as date) as event_date,
               cast(year(ts) as int) as fiscal_year, cast(month(ts) as int) as fiscal_period,
               case when event_type = 'error' then 'FAULT' when value > 100 then 'HIGH' else 'OK' end as label
               from events""",
            times=("event_hour",),
            dates=("event_date",),
        ),
        "first_rows": case(
            lambda spark, sf: first_rows(gold(spark, sf, "dim_equipment"), ["equipment_id"]),
            f"select * from ({model_sql('dim_equipment')}) order by equipment_id limit 5",
        ),
        "sentinel_rule": case(sentinel, SENTINEL_SQL),
        "text_widths": case(
            lambda spark, sf: text_widths(gold(spark, sf, "fact_harvest"), SERVING["fact_harvest"]),
            _widths_sql("fact_harvest"),
        ),
    }
    for source in CONTRACTS:
        found[f"clean_{source}"] = case(
            lambda spark, sf, source=source: silver(spark, sf, source),
            silver_sql(source),
            times=TIMES[source],
            dates=DATES.get(source, ()),
            decimals=("amount",) if source == "finance" else (),
        )
        found[f"lost_values_{source}"] = losses(source)
        if CONTRACTS[source].ranges:
            found[f"out_of_range_{source}"] = ranges(source)
    for model in SERVING:
        found[f"serving_{model}"] = _typed(model)
    return found
