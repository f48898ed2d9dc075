"""Balance chains, reconciliation, features and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import classify
from ledgerloom.operators import features as feat
from ledgerloom.operators.reconcile import balance_chain, reconcile
from ledgerloom.operators.summary import breakdown, line_counts
from ledgerloom.session import materialise
from workload.fixtures import ACCOUNTS_SQL, STATEMENTS_SQL, account_lines, perturbed, statement_lines
from workload.registry import query, table


@query(
    "statement_ledger",
    f"with {STATEMENTS_SQL} select statement_hash, bank_format, line_no, txn_date_raw, narration, "
    "debit_amount, credit_amount, running_balance, txn_type from lines",
)
def statement_ledger(spark: SparkSession, d: str) -> DataFrame:
    return statement_lines(spark, d).select(
        "statement_hash", "bank_format", "line_no", "txn_date_raw", "narration",
        "debit_amount", "credit_amount", "running_balance", "txn_type",
    )


@query(
    "account_ledger",
    f"with {ACCOUNTS_SQL} select statement_hash, event_id, line_no, running_balance from accounts",
)
def account_ledger(spark: SparkSession, d: str) -> DataFrame:
    return account_lines(spark, d).select("statement_hash", "event_id", "line_no", "running_balance")


_CHAIN_SQL = """
chained as (
  select *, last_value(running_balance ignore nulls) over
    (partition by statement_hash order by line_no rows between unbounded preceding and 1 preceding) as prev_balance
  from {source}),
checked as (
  select *, running_balance is not null and prev_balance is not null
              and (coalesce(debit_amount, 0) <> 0 or coalesce(credit_amount, 0) <> 0) as is_checked,
         abs(prev_balance - coalesce(debit_amount, 0.0) + coalesce(credit_amount, 0.0) - running_balance) <= 0.05 as agrees
  from chained)"""
_VERDICT_SQL = """
counts as (
  select statement_hash, count(*) as total_lines,
         count(*) filter (is_checked and agrees) as reconciled_lines,
         count(*) filter (is_checked and not agrees) as mismatch_count
  from checked group by 1),
verdicts as (
  select *, case when reconciled_lines = 0 then 'UNVERIFIED' when mismatch_count = 0 then 'PASSED'
                 when reconciled_lines > mismatch_count then 'PARTIAL' else 'FAILED' end as validation_status,
            case when reconciled_lines = 0 then 'No lines had both a prior balance and a debit/credit to check'
                 when mismatch_count = 0 then 'All lines reconciled within tolerance'
                 else mismatch_count || ' of ' || total_lines || ' lines did not reconcile' end as validation_notes
  from counts)"""


def chain_sql(source: str) -> str:
    return _CHAIN_SQL.format(source=source)


VERDICT_SQL = _VERDICT_SQL
_FEATURES_SQL = """
select statement_hash, bank_format, count(*) as total_transactions,
  round(sum(credit_amount), 2) as total_inflow, round(sum(debit_amount), 2) as total_outflow,
  round(avg(coalesce(debit_amount, credit_amount)) + 1e-7, 4) as avg_transaction_amount,
  min(running_balance) as min_balance, max(running_balance) as max_balance, round(avg(running_balance) + 1e-7, 4) as avg_balance,
  count(*) filter (txn_type = 'SALARY_CREDIT') as salary_credit_count,
  count(*) filter (txn_type = 'ATM_WITHDRAWL') as atm_withdrawl_count,
  count(*) filter (txn_type = 'UPI') as upi_txn_count,
  count(*) filter (txn_type = 'REVERSAL') as bounce_or_reversal_count,
  count(*) filter (txn_type = 'EMI') as emi_txn_count,
  count(distinct txn_type) as distinct_txn_types
from {source} group by 1, 2"""


def features_sql(source: str) -> str:
    return _FEATURES_SQL.format(source=source)


def rounded_features(df: DataFrame) -> DataFrame:
    """Order of summation differs between engines; sums to cents, averages to four places off ties."""
    return df.withColumns(
        {
            "total_inflow": F.round("total_inflow", 2),
            "total_outflow": F.round("total_outflow", 2),
            "avg_transaction_amount": F.round(F.col("avg_transaction_amount") + 1e-7, 4),
            "avg_balance": F.round(F.col("avg_balance") + 1e-7, 4),
        }
    )


@query(
    "balance_chain",
    f"""with {ACCOUNTS_SQL}, {chain_sql("ledger")}
    select statement_hash, line_no, prev_balance, cast(is_checked as int) as is_checked,
           cast(is_checked and agrees as int) as is_reconciled from checked""",
)
def balance_chain_query(spark: SparkSession, d: str) -> DataFrame:
    # the chunks that numbered the lines also carry the balances: the ledger is written once
    chain = balance_chain(perturbed(account_lines(spark, d, chunked=True)))
    return chain.select(
        "statement_hash", "line_no", "prev_balance",
        F.col("is_checked").cast("int").alias("is_checked"),
        F.coalesce(F.col("is_reconciled"), F.lit(False)).cast("int").alias("is_reconciled"),
    )


@query(
    "reconcile_status",
    f"with {ACCOUNTS_SQL}, {chain_sql('ledger')}, {VERDICT_SQL} select * from verdicts",
)
def reconcile_status(spark: SparkSession, d: str) -> DataFrame:
    return reconcile(perturbed(account_lines(spark, d)))


@query("account_features", f"with {ACCOUNTS_SQL} {features_sql('ledger')}")
def account_features_query(spark: SparkSession, d: str) -> DataFrame:
    return rounded_features(feat.account_features(perturbed(account_lines(spark, d))))


@query(
    "features_gated",
    f"""with {STATEMENTS_SQL}, broken as (
      select * replace (case when user_id % 2 = 0 and line_no % 2 = 0 then running_balance + 10 else running_balance end
                        as running_balance) from lines),
    {chain_sql("broken")}, {VERDICT_SQL},
    passing as (select b.* from broken b where statement_hash in
      (select statement_hash from verdicts where validation_status in ('PASSED', 'PARTIAL')))
    {features_sql("passing")}""",
)
def features_gated(spark: SparkSession, d: str) -> DataFrame:
    """Validation gate and rollup over statements, half of which have a fault on every second line."""
    faulty = (F.col("user_id") % 2 == 0) & (F.col("line_no") % 2 == 0)
    lines = statement_lines(spark, d).withColumn(
        "running_balance", F.when(faulty, F.col("running_balance") + 10).otherwise(F.col("running_balance"))
    )
    lines = materialise(lines, "ledger")
    gate = feat.validation_gate(reconcile(lines))
    return rounded_features(feat.gated_features(lines, gate))


@query("type_breakdown", f"with {STATEMENTS_SQL} select txn_type, count(*) as count from lines group by 1")
def type_breakdown(spark: SparkSession, d: str) -> DataFrame:
    narrated = statement_lines(spark, d).withColumn("txn_type", classify.txn_type(F.col("narration")))
    return breakdown(narrated, "txn_type")


@query(
    "line_counts",
    f"""with {STATEMENTS_SQL} select statement_hash, bank_format, count(*) as line_count,
        count(*) filter (txn_type = 'OTHER') as unclassified_other_count from lines group by 1, 2""",
)
def line_counts_query(spark: SparkSession, d: str) -> DataFrame:
    return line_counts(statement_lines(spark, d))


# narrations that hit every rule, near misses and direction prefixes
_NARRATIONS = (
    "UPI/P2M/", "NEFT-N123-", "RTGS/HDFC/", "IMPS-9-", "INB TRF ", "ATM WDL ", "ATM-CASH ", "POS PURCHASE ",
    "PUR/SHOP ", "CHQ DEP ", "CHEQUE-", "BRN-CLG ", "SALARY CR ", "SAL-CR ", "INTEREST PAID ", "INT.COLL ",
    "SMS CHG ", "CHARGES FOR ", "REVERSAL ", "RETURNED ITEM ", "EMI ", "LOAN DISB ", "CDM ", "CASH DEPOSIT ",
    "ECS ", "NACH ", "BILL/ELEC ", "BILLPAY ", "ECOM ", "GST ", "TDS ", "MOB BK ", "IB-TRANSFER ", "SWEEP ", "MOD ",
    "BY TRANSFER ", "TO TRANSFER ", "by cash ", "x/CR/", "x/DR-", "PAYMENT DR ", "CREDIT ", "rev ", "SUPI/", "NOTHING ",
)


def _narration():
    choices = F.array(*map(F.lit, _NARRATIONS))
    return F.concat(
        F.element_at(choices, (F.col("event_id") % len(_NARRATIONS) + 1).cast("int")), F.col("event_id").cast("string")
    )


_NARRATION_SQL = (
    "[" + ", ".join(f"'{n}'" for n in _NARRATIONS) + f"][event_id % {len(_NARRATIONS)} + 1] || event_id"
)


def type_sql(narration: str) -> str:
    whens = " ".join(
        f"when regexp_matches(lower({narration}), '{pattern}') then '{label}'" for label, pattern in rules.TYPE_RULES
    )
    return f"case {whens} else 'OTHER' end"


def direction_sql(narration: str) -> str:
    up = f"upper(trim({narration}))"
    return (
        f"case when {up} like 'BY %' then 'CREDIT' when {up} like 'TO %' then 'DEBIT' "
        rf"when regexp_matches({up}, '(?i)/CR[/\-]|\bCR\b|\brev(ersal)?\b') then 'CREDIT' "
        rf"when regexp_matches({up}, '/DR[/\-]|\bDR\b') then 'DEBIT' else 'UNKNOWN' end"
    )


@query(
    "classify_rules",
    f"""with n as (select event_id, {_NARRATION_SQL} as narration from events)
    select event_id, narration, {type_sql("narration")} as txn_type,
           case when {type_sql("narration")} = 'OTHER' then 0.3 else 0.9 end::double as classification_confidence from n""",
)
def classify_rules(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "events")
        .select("event_id", _narration().alias("narration"))
        .withColumn("txn_type", classify.txn_type(F.col("narration")))
        .withColumn("classification_confidence", classify.confidence(F.col("txn_type")))
    )


@query(
    "infer_direction",
    f"""with n as (select event_id, {_NARRATION_SQL} as narration,
                   [null, 'DR', ' d ', 'Debit', 'CR', 'c', 'CREDIT ', 'x'][event_id % 8 + 1] as flag from events),
    t as (select *, {type_sql("narration")} as txn_type from n)
    select event_id, {direction_sql("narration")} as by_narration,
           case lower(trim(flag)) when 'dr' then 'DEBIT' when 'd' then 'DEBIT' when 'debit' then 'DEBIT'
                when 'cr' then 'CREDIT' when 'c' then 'CREDIT' when 'credit' then 'CREDIT' else 'UNKNOWN' end as by_flag,
           case when txn_type in ('SALARY_CREDIT', 'INTEREST', 'REVERSAL', 'CASH_DEPOSIT') then 'CREDIT'
                else 'DEBIT' end as by_type
    from t""",
)
def infer_direction(spark: SparkSession, d: str) -> DataFrame:
    flags = F.array(*[F.lit(f) for f in (None, "DR", " d ", "Debit", "CR", "c", "CREDIT ", "x")])
    return (
        table(spark, d, "events")
        .select(
            "event_id",
            _narration().alias("narration"),
            F.element_at(flags, (F.col("event_id") % 8 + 1).cast("int")).alias("flag"),
        )
        .withColumn("txn_type", classify.txn_type(F.col("narration")))
        .select(
            "event_id",
            classify.narration_direction(F.col("narration")).alias("by_narration"),
            classify.flag_direction(F.col("flag")).alias("by_flag"),
            classify.default_direction(F.col("txn_type")).alias("by_type"),
        )
    )


@query(
    "refine_other",
    f"""with {STATEMENTS_SQL} select statement_hash, line_no,
      case when txn_type <> 'OTHER' then txn_type when credit_amount is not null then 'CREDIT_OTHER'
           when debit_amount is not null then 'DEBIT_OTHER' else txn_type end as refined from lines""",
)
def refine_other(spark: SparkSession, d: str) -> DataFrame:
    lines = statement_lines(spark, d).withColumn("_type", classify.txn_type(F.col("narration")))
    return lines.select(
        "statement_hash",
        "line_no",
        classify.refine_other(F.col("_type"), F.col("debit_amount"), F.col("credit_amount")).alias("refined"),
    )
