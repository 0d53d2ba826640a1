"""Balanced ledger lines from operational events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.functions.measures import money

# The signs of the two sides.
DEBIT, CREDIT = "S", "H"

# What an event must offer to be posted, by the names of the ledger's interface.
EVENT_COLUMNS = (
    "posting_timestamp",
    "cost_center_id",
    "debit_account",
    "credit_account",
    "transaction_type",
    "reference_document",
    "employee_id",
    "equipment_id",
    "material_id",
    "amount",
    "description",
)


def posting_reason() -> Column:
    """Why an event is not posted, NULL for one that is."""
    amount = F.col("amount")
    return (
        F.when(amount.isNull(), "no amount")
        .when(amount <= 0, "not positive")
        .when(money(amount).isNull(), "beyond money")
    )


def unposted_events(events: DataFrame) -> DataFrame:
    """The events that ``post_pairs`` leaves out, with the reason; with the posted ones they are all."""
    return events.withColumn("reason", posting_reason()).where(F.col("reason").isNotNull())


def post_pairs(events: DataFrame, company_code: Column, currency: Column) -> DataFrame:
    """Two lines per event with a positive amount (see ``unposted_events`` for the others): the debit and the credit of one document.

    The document number is made of the transaction type and the reference, so it does not depend
    on the order in which events are read. Both lines come out of one projection, without a shuffle.
    """
    amount = money(F.col("amount"))
    sides = F.array(
        F.struct(
            F.lit(DEBIT).alias("side"), F.col("debit_account").alias("account"), F.lit("Debit: ").alias("prefix")
        ),
        F.struct(
            F.lit(CREDIT).alias("side"), F.col("credit_account").alias("account"), F.lit("Credit: ").alias("prefix")
        ),
    )
    document = F.concat_ws("-", F.lit("DOC"), F.col("transaction_type"), F.col("reference_document"))
    posted = F.col("posting_timestamp")
    return (
        events.where(posting_reason().isNull())
        .withColumn("_line", F.explode(sides))
        .select(
            document.alias("document_id"),
            F.to_date(posted).alias("posting_date"),
            posted.alias("posting_timestamp"),
            F.year(posted).alias("fiscal_year"),
            F.month(posted).alias("fiscal_period"),
            company_code.alias("company_code"),
            F.col("cost_center_id"),
            F.col("_line.account").alias("gl_account"),
            F.col("transaction_type"),
            F.col("reference_document"),
            F.col("employee_id"),
            F.col("equipment_id"),
            F.col("material_id"),
            amount.alias("amount"),
            currency.alias("currency"),
            F.col("_line.side").alias("debit_credit_indicator"),
            F.concat(F.col("_line.prefix"), F.col("description")).alias("description"),
        )
    )


def document_balances(ledger: DataFrame) -> DataFrame:
    """Per document: lines on each side, both totals, and whether it is one debit and one equal credit."""
    side = F.col("debit_credit_indicator")
    zero = F.lit(0).cast("decimal(18,2)")
    per_document = ledger.groupBy("document_id").agg(
        F.count_if(side == DEBIT).alias("debit_lines"),
        F.count_if(side == CREDIT).alias("credit_lines"),
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(F.when(side == DEBIT, F.col("amount"))), zero).alias("debit"),
        F.coalesce(F.sum(F.when(side == CREDIT, F.col("amount"))), zero).alias("credit"),
    )
    pair = (F.col("debit_lines") == 1) & (F.col("credit_lines") == 1) & (F.col("lines") == 2)
    return per_document.withColumn("balanced", pair & (F.col("debit") == F.col("credit")))


def unbalanced_documents(ledger: DataFrame) -> DataFrame:
    return document_balances(ledger).where(~F.col("balanced"))
