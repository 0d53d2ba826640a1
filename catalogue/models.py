"""Dimensions, facts and quality checks."""

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F

from catalogue.case import CONTRACTS, case, gold, silver
from catalogue.raw import load, raw_source, raw_sql
from catalogue.silver_sql import KEYS, clean_sql, model_sql, one_per_key, silver_sql
from fieldlake.contracts import ModelSpec, Range, SourceContract
from fieldlake.operators.cleaning import clean
from fieldlake.operators.lookup import lookup, orphan_keys, orphan_summary
from fieldlake.operators.models import build_model
from fieldlake.operators.quality import compare_layers, dq_report, gate_status, layer_counts, missing_keys, reconcile, verify_tables
from fieldlake.plans.estate import MODELS

RUN_TS = datetime(2024, 2, 1, 6, 0, 0)
AS_OF = date(2024, 2, 20)

MODEL_TIMES = {
    "fact_harvest": {"dates": ("harvest_date",), "times": ("harvest_timestamp",)},
    "fact_revenue": {"dates": ("posting_date",), "decimals": ("amount",)},
    "fact_fertilizer": {"dates": ("application_date",), "times": ("application_timestamp",)},
    "fact_equipment": {"dates": ("operation_date",), "times": ("operation_timestamp",)},
}

DIM_PART = ModelSpec(
    name="dim_part",
    source="lineitem",
    key=("part_id",),
    required=("part_id",),
    columns={"part_id": "l_partkey", "last_supplier": "l_suppkey", "last_flag": "l_returnflag"},
    latest_by="l_shipdate",
)

FACT_LINES = ModelSpec(
    name="fact_lines",
    source="lineitem",
    key=("order_id", "line_number"),
    required=("order_id",),
    columns={
        "order_id": "l_orderkey",
        "line_number": "l_linenumber",
        "ship_date": "to_date(l_shipdate)",
        "part_id": "l_partkey",
        "supplier_id": "l_suppkey",
        "quantity": "l_quantity",
        "price": "cast(l_extendedprice as decimal(18,2))",
        "flag": "l_returnflag",
    },
    event_date="ship_date",
)

# The lines as an already typed source, to check a table that is not clean.
LINES = SourceContract(
    name="lineitem",
    file_name="",
    columns="""
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
        l_linestatus string, l_shipdate timestamp
    """,
    key=("l_orderkey", "l_linenumber"),
    required=("l_orderkey", "l_linenumber"),
    ranges=(Range("l_quantity", 1, 45), Range("l_discount", 0), Range("l_tax", None, 0.05)),
)


def lines_report(spark, sf):
    """The lines checked against a count that the orders give: four lines an order."""
    expected = 4 * load(spark, sf, "orders").count()
    return dq_report(load(spark, sf, "lineitem"), replace(LINES, expected_rows=expected), as_of=AS_OF)


def dim_customer(spark, sf):
    """Customers with the names of their nation and region: two lookups on small tables."""
    customer, nation, region = (load(spark, sf, t) for t in ("customer", "nation", "region"))
    placed = lookup(customer, nation, {"c_nationkey": "n_nationkey"}, {"n_name": "NOWHERE", "n_regionkey": -1})
    named = lookup(placed, region, {"n_regionkey": "r_regionkey"}, {"r_name": "NOWHERE"})
    return named.select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")


def stamped_silver(spark, sf, source):
    return clean(raw_source(spark, sf, source), CONTRACTS[source], F.lit(RUN_TS))


def report(spark, sf, source):
    return dq_report(
        stamped_silver(spark, sf, source),
        CONTRACTS[source],
        as_of=AS_OF,
        raw=raw_source(spark, sf, source),
    )


def _row(source, check, passed, metric, expected, detail):
    critical = "true" if check not in ("valid_ranges", "freshness") else "false"
    return f"""select '{source}' as source, '{check}' as "check", coalesce({passed}, false) as passed,
      {critical} as critical, cast({metric} as bigint) as metric, cast({expected} as bigint) as expected,
      {detail} as detail from counts"""


def _listing(parts):
    pieces = ", ".join(f"case when {n} > 0 then '{name}=' || {n} end" for name, n in parts.items())
    return f"coalesce(nullif(concat_ws(', ', {pieces}), ''), 'none')"


def report_sql(source, table, keys, ranges, stamped=True, raw=None, expected_rows=None):
    """All checks of a table in SQL, every one counted on its own."""
    nulls = {key: f'(select count(*) from data where "{key}" is null)' for key in keys}
    outs = {}
    for rule in ranges:
        sides = [f'"{rule.column}" < {rule.low}'] if rule.low is not None else []
        sides += [f'"{rule.column}" > {rule.high}'] if rule.high is not None else []
        outs[rule.column] = f"(select count(*) from data where {' or '.join(sides)})"
    part = ", ".join(f'"{key}"' for key in keys)
    dup = f"(select cast(sum(n - 1) as bigint) from (select count(*) as n from data group by {part}))"
    nulls_sum, outs_sum = " + ".join(nulls.values()), " + ".join(outs.values())
    lacking = "true" if stamped else "false"
    rows = [
        _row(source, "schema", lacking, 0 if stamped else 1, 0, f"'{'none' if stamped else 'missing: _ingested_at'}'"),
        _row(source, "nulls", f"({nulls_sum}) = 0", f"({nulls_sum})", 0, _listing(nulls)),
        _row(source, "duplicates", f"{dup} = 0", dup, 0, f"'{', '.join(keys)}'"),
        _row(source, "valid_ranges", f"({outs_sum}) = 0", f"({outs_sum})", 0, _listing(outs)),
    ]
    if expected_rows is not None:
        rows.append(_row(source, "row_count", f"rows = {expected_rows}", "rows", expected_rows, "'rows'"))
    age = "date_diff('day', date '2024-02-01', date '2024-02-20')" if stamped else "null"
    rows.append(_row(source, "freshness", f"{age} <= 30", age, 30, "'age in days of the newest row'"))
    if raw is not None:
        count = f"(select count(*) from (select distinct {raw['keys']} from ({raw['sql']})))"
        rows.append(_row(source, "reconciliation", f"rows = {count}", "rows", count, "'silver rows, raw keys'"))
    return f"with data as ({table}), counts as (select count(*) as rows from data) " + " union all ".join(rows)


def _raw_side(source):
    keys = ", ".join(f'upper(trim("{key}")) as "{key}"' for key in KEYS[source])
    return {"keys": keys, "sql": raw_sql(source)}


def _silver_report_sql(source):
    return report_sql(source, silver_sql(source), KEYS[source], CONTRACTS[source].ranges, raw=_raw_side(source))


LINES_SQL = report_sql(
    "lineitem", "select * from lineitem", LINES.key, LINES.ranges, stamped=False,
    expected_rows="(select 4 * count(*) from orders)",
)


def _reconcile_sql(source):
    side = _raw_side(source)
    return f"""select silver_rows, raw_keys, silver_rows = raw_keys as reconciled from
      (select count(*) as silver_rows from ({silver_sql(source)})),
      (select count(*) as raw_keys from (select distinct {side['keys']} from ({side['sql']})))"""


def unfinished_silver(spark, sf):
    """The cleaned harvest as if a run had lost the rows without a weight."""
    return silver(spark, sf, "harvest").where(F.col("harvested_weight_kg").isNotNull())


def _verify_sql(model):
    key = MODELS[model].key
    part = ", ".join(key)
    null = " or ".join(f"{k} is null" for k in key)
    wanted = "cast(1 as bigint)" if model == "fact_harvest" else "cast(null as bigint)"
    return f"""select *, coalesce(duplicate_keys = 0 and null_keys = 0 and (expected_rows is null or rows = expected_rows), false)
      as passed from (select '{model}' as table_name, count(*) as rows,
      count(*) - count(distinct ({part})) as duplicate_keys,
      count(*) filter (where {null}) as null_keys, {wanted} as expected_rows from ({model_sql(model)}))"""


COUNTED = ("lineitem", "orders", "events", "customer", "part", "supplier", "nation", "region")
RAW_AND_CLEAN = ("weather", "harvest", "fertilizer", "equipment", "hr", "finance")


def cases():
    found = {
        "dim_part": case(
            lambda spark, sf: build_model(load(spark, sf, "lineitem"), DIM_PART),
            one_per_key(
                "select l_partkey as part_id, l_suppkey as last_supplier, l_returnflag as last_flag, l_shipdate from lineitem",
                ("part_id",),
                ["part_id", "last_supplier", "last_flag"],
                "l_shipdate desc nulls last",
            ),
        ),
        "dim_customer": case(
            dim_customer,
            """select c_custkey, c_name, c_mktsegment, coalesce(n_name, 'NOWHERE') as n_name,
               coalesce(r_name, 'NOWHERE') as r_name
               from customer left join nation on c_nationkey = n_nationkey
               left join region on n_regionkey = r_regionkey""",
        ),
        "fact_lines": case(
            lambda spark, sf: build_model(load(spark, sf, "lineitem"), FACT_LINES),
            one_per_key(
                """select l_orderkey as order_id, l_linenumber as line_number, cast(l_shipdate as date) as ship_date,
                   l_partkey as part_id, l_suppkey as supplier_id, l_quantity as quantity,
                   cast(l_extendedprice as decimal(18,2)) as price, l_returnflag as flag from lineitem""",
                ("order_id", "line_number"),
                ["order_id", "line_number", "ship_date", "part_id", "supplier_id", "quantity", "price", "flag"],
            ),
            dates=("ship_date",),
            decimals=("price",),
        ),
        "dq_report_lines": case(lines_report, LINES_SQL),
        "gate_status_lines": case(
            lambda spark, sf: gate_status(lines_report(spark, sf)),
            f"""select checks, critical_failures, other_failures, critical_failures = 0 as open from (
                select count(*) as checks, count(*) filter (where critical and not passed) as critical_failures,
                count(*) filter (where not critical and not passed) as other_failures from ({LINES_SQL}))""",
        ),
        "missing_keys_harvest": case(
            lambda spark, sf: missing_keys(
                raw_source(spark, sf, "harvest"), unfinished_silver(spark, sf), CONTRACTS["harvest"]
            ),
            f"""select distinct harvest_id from ({clean_sql('harvest')})
                where harvest_id is not null and "timestamp" is not null and harvest_id not in
                (select harvest_id from ({silver_sql('harvest')}) where harvested_weight_kg is not null)""",
        ),
        "table_counts": case(
            lambda spark, sf: layer_counts({t: load(spark, sf, t) for t in COUNTED}),
            " union all ".join(f"select '{t}' as table_name, count(*) as rows from {t}" for t in COUNTED),
        ),
        "layer_comparison": case(
            lambda spark, sf: compare_layers(
                {name: raw_source(spark, sf, name) for name in (*RAW_AND_CLEAN, "sensors")},
                {name: silver(spark, sf, name) for name in RAW_AND_CLEAN},
            ),
            "select table_name, left_rows, right_rows, left_rows is not distinct from right_rows as same from ("
            + " union all ".join(
                f"""select '{n}' as table_name, (select count(*) from ({raw_sql(n)})) as left_rows,
                    {f"(select count(*) from ({silver_sql(n)}))" if n in RAW_AND_CLEAN else "cast(null as bigint)"}
                    as right_rows"""
                for n in (*RAW_AND_CLEAN, "sensors")
            )
            + ")",
        ),
        "verified_models": case(
            lambda spark, sf: verify_tables(
                {name: (gold(spark, sf, name), spec.key) for name, spec in MODELS.items()}, {"fact_harvest": 1}
            ),
            " union all ".join(_verify_sql(name) for name in MODELS),
        ),
        "orphan_employees": case(
            lambda spark, sf: orphan_keys(
                silver(spark, sf, "harvest"), silver(spark, sf, "hr"), {"employee_id": "employee_id"}
            ),
            f"""select employee_id, count(*) as child_rows from ({silver_sql('harvest')})
                where employee_id is not null and employee_id not in
                (select employee_id from ({silver_sql('hr')}) where employee_id is not null) group by 1""",
        ),
        "orders_without_lines": case(
            lambda spark, sf: orphan_keys(
                load(spark, sf, "orders"), load(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"}
            ),
            """select o_orderkey, count(*) as child_rows from orders
               where not exists (select 1 from lineitem where l_orderkey = o_orderkey) group by 1""",
        ),
        "orphan_summary": case(
            lambda spark, sf: orphan_summary(
                silver(spark, sf, "harvest"), silver(spark, sf, "fertilizer"), {"crop_type": "crop_type"}
            ),
            f"""with child as ({silver_sql('harvest')}), parent as ({silver_sql('fertilizer')})
                select count(*) as child_rows,
                count(*) filter (where crop_type is not null and not known) as orphan_rows,
                count(distinct crop_type) filter (where crop_type is not null and not known) as orphan_keys,
                count(*) filter (where crop_type is null) as null_key_rows
                from (select crop_type, crop_type in (select crop_type from parent
                      where crop_type is not null) as known from child)""",
        ),
    }
    for model in MODELS:
        found[model] = case(
            lambda spark, sf, model=model: gold(spark, sf, model), model_sql(model), **MODEL_TIMES.get(model, {})
        )
    for source in RAW_AND_CLEAN:
        found[f"dq_report_{source}"] = case(
            lambda spark, sf, source=source: report(spark, sf, source), _silver_report_sql(source)
        )
        found[f"reconcile_{source}"] = case(
            lambda spark, sf, source=source: reconcile(
                raw_source(spark, sf, source), silver(spark, sf, source), CONTRACTS[source]
            ),
            _reconcile_sql(source),
        )
    return found
