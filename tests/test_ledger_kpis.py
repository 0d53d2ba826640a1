"""The ledger's key figures name the currencies in use."""

import pytest

from fieldlake.plans.reports import ledger_kpis

LINES = "debit_credit_indicator string, transaction_type string, currency string, amount decimal(18,2)"


@pytest.mark.parametrize(
    ("used", "told"),
    [(["USD", "MYR", None, "EUR", "MYR"], "EUR,MYR,USD"), ([None, None], None), (["", None], ""), ([], None)],
)
def test_currencies_in_use_are_listed_in_order(spark, used, told):
    rows = [("S" if i % 2 else "H", "WAGES", currency, None) for i, currency in enumerate(used)]
    assert ledger_kpis(spark.createDataFrame(rows, LINES)).first().currencies == told
