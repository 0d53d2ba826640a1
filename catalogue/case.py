"""What a query of the catalogue is made of."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalogue.raw import raw_source
from fieldlake.operators.cleaning import clean
from fieldlake.operators.models import build_model
from fieldlake.plans.estate import BATCH_SOURCES, MODELS, SENSORS
from fieldlake.session import use_utc

CONTRACTS = {**BATCH_SOURCES, "sensors": SENSORS}


@dataclass(frozen=True)
class Case:
    """A query and, where SQL can say it, the SQL it must agree with."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def silver(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return clean(raw_source(spark, sf_dir, source), CONTRACTS[source])


def gold(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    spec = MODELS[model]
    return build_model(silver(spark, sf_dir, spec.source), spec, unique_by=CONTRACTS[spec.source].key)


# Places of a mean of means, whose summands neither engine can add exactly.
PLACES = 6


def shown(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles: engines and drivers print them differently."""
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss.SSSSSS"}

    def show(name: str, kind: str) -> Column:
        if kind in formats:
            return F.date_format(F.col(name), formats[kind]).alias(name)
        if name in rounded:
            return F.round(F.col(name), PLACES).alias(name)
        return F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)

    return df.select(*[show(name, kind) for name, kind in df.dtypes])


def shown_sql(
    sql: str, dates: tuple[str, ...] = (), times: tuple[str, ...] = (), decimals: tuple[str, ...] = (),
    rounded: tuple[str, ...] = (),
) -> str:
    """The same for SQL."""
    parts = [f"strftime(\"{name}\", '%Y-%m-%d') as \"{name}\"" for name in dates]
    parts += [f"strftime(\"{name}\", '%Y-%m-%d %H:%M:%S.%f') as \"{name}\"" for name in times]
    parts += [f'cast("{name}" as double) as "{name}"' for name in decimals]
    parts += [f'round("{name}", {PLACES}) as "{name}"' for name in rounded]
    return f"select * replace ({', '.join(parts)}) from ({sql})" if parts else sql


def case(
    run: Callable[[SparkSession, str], DataFrame], sql: str | None = None, rounded: tuple[str, ...] = (), **shapes
) -> Case:
    """A case whose times and decimals are shown the same way on both sides."""
    return Case(
        lambda spark, sf_dir: shown(run(use_utc(spark), sf_dir), rounded),
        None if sql is None else shown_sql(sql, rounded=rounded, **shapes),
    )
