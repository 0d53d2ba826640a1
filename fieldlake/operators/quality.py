"""Quality checks as one report table, and the gate that reads it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.contracts import SourceContract
from fieldlake.errors import QualityError
from fieldlake.functions.measures import outside
from fieldlake.functions.text import code
from fieldlake.operators.cleaning import INGESTED_AT, clean_rows

# Check names, and those that stop a run (fixed values).
CHECKS = ("schema", "nulls", "duplicates", "row_count", "valid_ranges", "freshness", "reconciliation")
CRITICAL = frozenset({"schema", "nulls", "duplicates", "row_count", "reconciliation"})
FRESHNESS_MAX_AGE_DAYS = 30

REPORT_COLUMNS = ("source", "check", "passed", "critical", "metric", "expected", "detail")
REPORT_SCHEMA = "source string, check string, passed boolean, critical boolean, metric bigint, expected bigint, detail string"


def _result(check: str, passed: Column, metric: Column, expected: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(check in CRITICAL).alias("critical"),
        metric.cast("bigint").alias("metric"),
        expected.cast("bigint").alias("expected"),
        detail.cast("string").alias("detail"),
    )


def _listing(counts: Mapping[str, Column]) -> Column:
    """``a=3, b=1`` for the counts that are not zero, else ``none``."""
    parts = [F.when(n > 0, F.concat(F.lit(f"{name}="), n.cast("string"))) for name, n in counts.items()]
    text = F.concat_ws(", ", *parts) if parts else F.lit("")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("none"))


def _plus(columns: Sequence[Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for column in columns:
        total = total + column
    return total


def dq_report(
    df: DataFrame,
    contract: SourceContract,
    as_of: date | None = None,
    raw: DataFrame | None = None,
    required_columns: Sequence[str] | None = None,
    freshness_mode: str = "newest",
    max_age_days: int = FRESHNESS_MAX_AGE_DAYS,
) -> DataFrame:
    """All checks of a cleaned table: (source, check, passed, critical, metric, expected, detail).

    The table is read once. Rows are first counted per key, partially in every task, and the
    per-key counts are then added up, so neither a hot key nor a large table gathers in one task.
    ``row_count`` needs an expected number in the contract, ``freshness`` an ``as_of`` date and
    ``reconciliation`` the raw table; without these the check is left out.
    """
    required = list(required_columns or [*contract.column_names, INGESTED_AT])
    missing = [name for name in required if name not in df.columns]
    keys = [name for name in contract.key if name in df.columns]
    rules = [rule for rule in contract.ranges if rule.column in df.columns]
    age = None
    if as_of is not None and INGESTED_AT in df.columns:
        pick = F.min if freshness_mode == "oldest" else F.max
        age = pick(F.col(INGESTED_AT)).alias("stamp")

    per_key = [F.count(F.lit(1)).alias("rows")]
    for i, rule in enumerate(rules):
        per_key.append(F.count_if(outside(F.col(rule.column), rule.low, rule.high)).alias(f"out_{i}"))
    if age is not None:
        per_key.append(age)
    grouped = df.groupBy(*keys).agg(*per_key) if keys else df.agg(*per_key)

    def added(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    totals = [added("rows").alias("rows"), F.count(F.lit(1)).alias("distinct_keys")]
    for i, name in enumerate(keys):
        nulls = F.sum(F.when(F.col(name).isNull(), F.col("rows")))
        totals.append(F.coalesce(nulls, F.lit(0)).alias(f"null_{i}"))
    totals += [added(f"out_{i}").alias(f"out_{i}") for i in range(len(rules))]
    if age is not None:
        pick = F.min if freshness_mode == "oldest" else F.max
        totals.append(pick("stamp").alias("stamp"))
    one_row = grouped.agg(*totals)

    rows, none = F.col("rows"), F.lit(None)
    duplicates = rows - F.col("distinct_keys")
    null_counts = {name: F.col(f"null_{i}") for i, name in enumerate(keys)}
    out_counts: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        out_counts[rule.column] = out_counts.get(rule.column, F.lit(0)) + F.col(f"out_{i}")
    null_total, out_total = _plus(list(null_counts.values())), _plus(list(out_counts.values()))
    zero = F.lit(0)
    results = [
        _result(
            "schema",
            F.lit(not missing),
            F.lit(len(missing)),
            zero,
            F.lit("missing: " + ", ".join(missing) if missing else "none"),
        ),
        _result("nulls", null_total == 0, null_total, zero, _listing(null_counts)),
        _result("duplicates", duplicates == 0, duplicates, zero, F.lit(", ".join(keys))),
    ]
    if contract.expected_rows is not None:
        wanted = F.lit(contract.expected_rows)
        results.append(_result("row_count", rows == wanted, rows, wanted, F.lit("rows")))
    results.append(_result("valid_ranges", out_total == 0, out_total, zero, _listing(out_counts)))
    if as_of is not None:
        days = F.datediff(F.lit(as_of), F.col("stamp")) if age is not None else F.lit(None).cast("int")
        detail = F.lit(f"age in days of the {freshness_mode} row")
        results.append(_result("freshness", days <= max_age_days, days, F.lit(max_age_days), detail))
    if raw is not None:
        one_row = one_row.withColumn("raw_keys", raw_key_count(raw, contract).scalar())
        raw_keys = F.col("raw_keys")
        results.append(_result("reconciliation", rows == raw_keys, rows, raw_keys, F.lit("silver rows, raw keys")))
    report = one_row.select(F.explode(F.array(*results)).alias("_result")).select("_result.*")
    return report.withColumn("source", F.lit(contract.name)).select(*REPORT_COLUMNS)


def _raw_keys(raw: DataFrame, contract: SourceContract) -> DataFrame:
    """The distinct keys of a raw table, text parts upper-cased and trimmed but not parsed."""
    texts = {f.name for f in raw.schema.fields if f.dataType.simpleString() == "string"}
    keys = [code(F.col(name)).alias(name) if name in texts else F.col(name) for name in contract.key]
    return raw.select(*keys).distinct()


def raw_key_count(raw: DataFrame, contract: SourceContract) -> DataFrame:
    return _raw_keys(raw, contract).agg(F.count(F.lit(1)).alias("raw_keys"))


def reconcile(raw: DataFrame, silver: DataFrame, contract: SourceContract) -> DataFrame:
    """One row: cleaned rows, distinct raw keys and whether they agree.

    The raw side compares text. Two spellings of one time, or a row dropped for a NULL key, are
    therefore a mismatch; ``missing_keys`` and ``parse_losses`` tell which.
    """
    counted = silver.agg(F.count(F.lit(1)).alias("silver_rows"))
    return counted.withColumn("raw_keys", raw_key_count(raw, contract).scalar()).withColumn(
        "reconciled", F.col("silver_rows") == F.col("raw_keys")
    )


def missing_keys(raw: DataFrame, silver: DataFrame, contract: SourceContract) -> DataFrame:
    """Parsed keys of the raw table that the cleaned table lacks."""
    keys = list(contract.key)
    parsed = clean_rows(raw, contract).select(*keys).distinct()
    same = F.lit(True)
    for name in keys:
        same = same & F.col(f"r.{name}").eqNullSafe(F.col(f"s.{name}"))
    return parsed.alias("r").join(silver.select(*keys).distinct().alias("s"), same, "left_anti")


def implication_check(df: DataFrame, when: Column, then: Mapping[str, Column]) -> DataFrame:
    """Rows for which ``when`` holds, and per rule how many of them break it: (rule, rows, broken).

    An unknown outcome counts as broken.
    """
    holds = F.coalesce(when, F.lit(False))
    broken = [F.count_if(holds & ~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in then.items()]
    counted = df.agg(F.count_if(holds).alias("rows"), *broken)
    return counted.unpivot(["rows"], list(then), "rule", "broken").select("rule", "rows", "broken")


def layer_counts(tables: Mapping[str, DataFrame], name: str = "rows") -> DataFrame:
    """Rows per table: (table_name, <name>)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)
        for table, df in tables.items()
    ]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return union


def compare_layers(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of two layers side by side; a table that one layer lacks has NULL there."""
    sides = layer_counts(left, "left_rows").join(layer_counts(right, "right_rows"), "table_name", "full")
    return sides.withColumn("same", F.col("left_rows").eqNullSafe(F.col("right_rows")))


def verify_tables(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], expected: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per finished table, given with its key: rows, duplicate keys, rows with a NULL key
    part, the expected rows if known, and whether all is well."""
    checked = []
    for name, (df, keys) in tables.items():
        has_null = F.lit(False)
        for key in keys:
            has_null = has_null | F.col(key).isNull()
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        wanted = F.lit((expected or {}).get(name)).cast("bigint")
        counts = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        )
        checked.append(counts.select(F.lit(name).alias("table_name"), "*", wanted.alias("expected_rows")))
    union = checked[0]
    for other in checked[1:]:
        union = union.unionByName(other)
    complete = F.col("expected_rows").isNull() | (F.col("rows") == F.col("expected_rows"))
    return union.withColumn("passed", (F.col("duplicate_keys") == 0) & (F.col("null_keys") == 0) & complete)


def gate_status(report: DataFrame) -> DataFrame:
    """One row: number of checks, failures that stop a run, other failures, and whether it may go on."""
    failed = ~F.col("passed")
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(failed & F.col("critical")).alias("critical_failures"),
        F.count_if(failed & ~F.col("critical")).alias("other_failures"),
    ).withColumn("open", F.col("critical_failures") == 0)


def dq_gate(report: DataFrame) -> list[str]:
    """Raise if a critical check failed; return the other failures as text.

    Only failed checks come to the driver, at most a handful per source.
    """
    failures = report.where(~F.col("passed")).collect()
    told = {
        row: f"{row['source']}.{row['check']}: {row['metric']} (expected {row['expected']}) {row['detail']}"
        for row in failures
    }
    critical = [text for row, text in told.items() if row["critical"]]
    if critical:
        raise QualityError("critical checks failed: " + "; ".join(critical))
    return list(told.values())
