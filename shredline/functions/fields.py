"""Field specifications as data: the narrow and wide reporting tables and a field catalogue.

The catalogue of a deployment is a parameter (``read_catalogue``); the built-in one, ``catalogue.csv`` beside this module, names all
fields c0 to c255, field c20 by index."""

from __future__ import annotations

import csv
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Code and column, in column order.
NARROW = [
    ("c1", "customer_id"), ("c2", "category_code"), ("c3", "account_title"), ("c7", "mnemonic"), ("c8", "account_currency_code"),
    ("c78", "opening_date_text"), ("c85", "product_category_code"), ("c252", "company_code"),
]
#: The field that the lookup calls mnemonic; an opt-in correction of the narrow table.
NARROW_CORRECTED = [(("c6" if name == "mnemonic" else code), name) for code, name in NARROW]
# Code and column, in column order.
WIDE = [
    ("c11", "account_officer"), ("c3", "account_title_1"), ("c108", "allow_netting"), ("c29", "amnt_last_cr_cust"),
    ("c41", "amnt_last_dr_auto"), ("c44", "amnt_last_dr_bank"), ("c2", "category"), ("c93", "charge_ccy"), ("c248", "curr_no"),
    ("c8", "currency"), ("c31", "date_last_cr_auto"), ("c43", "date_last_dr_bank"), ("c37", "date_last_dr_cust"),
    ("c167", "date_last_update"), ("c96", "interest_mkt"), ("c23", "open_actual_bal"), ("c78", "opening_date"), ("c76", "passbook"),
    ("c7", "position_type"), ("c5", "short_title"), ("c77", "start_year_bal"), ("c33", "tran_last_cr_auto"),
    ("c36", "tran_last_cr_bank"), ("c30", "tran_last_cr_cust"), ("c42", "tran_last_dr_auto"), ("c45", "tran_last_dr_bank"),
    ("c39", "tran_last_dr_cust"), ("c32", "amnt_last_cr_auto"), ("c35", "amnt_last_cr_bank"), ("c38", "amnt_last_dr_cust"),
    ("c251", "authoriser"), ("c94", "charge_mkt"), ("c252", "co_code"), ("c21", "condition_group"), ("c9", "currency_market"),
    ("c1", "customer"), ("c34", "date_last_cr_bank"), ("c28", "date_last_cr_cust"), ("c40", "date_last_dr_auto"),
    ("c253", "dept_code"), ("c121", "from_date"), ("c141", "hvt_flag"), ("c95", "interest_ccy"), ("c122", "locked_amount"),
    ("c25", "online_actual_bal"), ("c26", "online_cleared_bal"), ("c149", "open_available_bal"), ("c85", "open_category"),
    ("c24", "open_cleared_bal"), ("c27", "working_balance"),
]
WIDE_ARRAYS = [
    ("c20", "c20_values"), ("c46", "cap_date_charge_values"), ("c47", "cap_date_cr_int_values"), ("c48", "cap_date_c2_int_values"),
    ("c49", "cap_date_dr_int_values"), ("c50", "cap_date_d2_int_values"), ("c99", "alt_acct_type_values"),
    ("c100", "alt_acct_id_values"), ("c249", "inputter_values"), ("c250", "date_time_values"),
]
# Names of c20's indices from 1.
C20_NAMES = [
    "activyty", "version_name", "debit_or_credit", "arabic_title", "hold_date", "expiry_date", "hold_amount", "hold_details", "hold_user",
    "hold_reason", "old_account", "collateral_code_for_reports", "start_nab", "end_nab", "ft_ref_nab", "stmt_date", "ebc_auth_no",
    "ac_amt_loc", "approval_date", "under_age_no_of_months", "under_age_interest_date", "accroual_amount", "email_address",
    "no_of_bonds", "matur_date", "cost_bonds", "prev_bal", "price_eval", "eval_bal", "revaluation", "comp_code", "nab_flag",
    "welcome_pack", "account_purpose",
]
EFFECTIVE_DATE = "2026-08-02"
CATALOGUE_SCHEMA = "field_index string, multi_value_index int, field_name string, effective_date date"


BUILT_IN = Path(__file__).with_name("catalogue.csv")


@cache
def catalogue_rows() -> list[tuple[str, int | None, str]]:
    with BUILT_IN.open(newline="", encoding="utf-8") as f:
        return [(r["field_index"], int(r["m_index"]) if r["m_index"] else None, r["resolved_name_en"]) for r in csv.DictReader(f)]


def inline_catalogue(spark: SparkSession) -> DataFrame:
    """The built-in catalogue as a VALUES relation with typed nulls and date literals."""
    values = ", ".join(f"('{c}', CAST({'NULL' if i is None else i} AS INT), '{n}', DATE'{EFFECTIVE_DATE}')" for c, i, n in catalogue_rows())
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(field_index, multi_value_index, field_name, effective_date)")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue file with header ``table_name, field_index, m_index, resolved_name_en, dt``."""
    raw = spark.read.csv(path, header=True, schema="table_name string, field_index string, m_index string, resolved_name_en string, dt string")
    index = F.nullif("m_index", F.lit("")).try_cast("int")
    return raw.select("field_index", index.alias("multi_value_index"), F.col("resolved_name_en").alias("field_name"), F.col("dt").try_cast("date").alias("effective_date"))
