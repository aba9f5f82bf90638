"""Credit study: client table to cleaned features, classes, clusters and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import vocab
from millrace.functions.labels import inverted, recode, sex_status
from millrace.functions.scalar import (
    delay_band,
    mean_of,
    monthly_expenses,
    running_debts,
    worst_status,
)
from millrace.operators.cleaning import fill_group_mode, fill_mode, replace_invalid
from millrace.operators.features import quantile_codes
from millrace.operators.rules import row_baskets
from millrace.session import written

FEATURES = [
    "credit_limit", "sex", "education", "status", "age", "avg_debt", "missed_payments", "avg_expense",
    "avg_ba", "avg_pa",
]
BASKET_COLUMNS = [
    "age_discr", "pa_sep_discr", "ba_sep_discr", "missed_payments", "credit_limit_discr", "sex",
    "education", "status", "credit_default",
]


def coded(df: DataFrame) -> DataFrame:
    out = {
        "sex": recode("sex", vocab.SEX_CODES),
        "education": recode("education", vocab.EDUCATION_CODES),
        "status": recode("status", vocab.STATUS_CODES),
    }
    if "credit_default" in df.columns:
        out["credit_default"] = recode("credit_default", vocab.DEFAULT_CODES)
    return df.withColumns(out)


def filled(df: DataFrame) -> DataFrame:
    """Sex and education by table mode, status by mode of (education, sex) or else of the
    table, age by mean of the valid ages of the same sex and status."""
    # Stored twice: the modes of later columns would else work out those of earlier ones again.
    df = written(fill_mode(fill_mode(written(df, "coded"), "sex"), "education"), "two_filled")
    df = fill_mode(written(fill_group_mode(df, "status", ["education", "sex"]), "three_filled"), "status")
    df = df.withColumn("sex_status", sex_status())
    return replace_invalid(df, "age", F.col("age") >= vocab.YOUNGEST_VALID_AGE, ["sex_status"])


def derived(df: DataFrame) -> DataFrame:
    debts, expenses = running_debts(), monthly_expenses()
    df = df.withColumns({**debts, **expenses, "missed_payments": worst_status()})
    df = df.withColumns(
        {
            "avg_debt": mean_of(list(debts)),
            "avg_expense": mean_of(list(expenses)),
            "avg_ba": mean_of([f"ba_{m}" for m in vocab.MONTHS]),
            "avg_pa": mean_of([f"pa_{m}" for m in vocab.MONTHS]),
        }
    )
    return df.withColumns(
        {
            "avg_debt_to_limit_ratio": F.try_divide("avg_debt", "credit_limit"),
            "avg_expense_to_limit_ratio": F.try_divide("avg_expense", "credit_limit"),
        }
    )


def cleaned(df: DataFrame) -> DataFrame:
    return derived(filled(coded(df)))


def client_items(df: DataFrame) -> DataFrame:
    """``client_id, items``: nine items per client, numbers as codes of eight equal-count bins."""
    rows = cleaned(df)
    rows = quantile_codes(rows, ["age", "pa_sep", "ba_sep", "credit_limit"], 8)
    words = {
        "missed_payments": delay_band("missed_payments"),
        "sex": recode("sex", inverted(vocab.SEX_CODES)),
        "education": recode("education", inverted(vocab.EDUCATION_CODES)),
        "status": recode("status", inverted(vocab.STATUS_CODES)),
        "credit_default": recode("credit_default", inverted(vocab.DEFAULT_CODES)),
    }
    return row_baskets(rows.withColumns(words), "client_id", BASKET_COLUMNS)
