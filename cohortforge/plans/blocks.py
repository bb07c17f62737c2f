"""The per-table feature blocks of the source job, one ``groupBy`` each.

Each block label-encodes the table's text columns (missing -> ``NULL``,
sorted codes), derives its extra columns, and reduces the table to one row
per key with a spec ``{column: [aggregates]}``.  Specs and prefixes default
to the source job's and can be replaced for other tables.

With ``check_size`` a block counts its text values when it is built (one job a
table) and broadcasts their codes up to a bound.  Without it building runs no
job, but the join with the codes shuffles all rows by the category's value:
a table of three flags is then the work of three tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.semantics import clip_positive, ratio, sentinel_to_null
from cohortforge.operators.aggregate import agg_spec, group_by_key, group_by_spec
from cohortforge.operators.encode import label_encode

# Aggregate specs of the source job.
BUREAU_NUM_SPEC = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
PREV_NUM_SPEC = {
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
}
PREV_SENTINEL_COLS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
                      "DAYS_LAST_DUE", "DAYS_TERMINATION"]
POS_SPEC = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
INS_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
}
CC_AGGS = ["min", "max", "mean", "sum", "var"]


def _with_cat_means(spec: Mapping[str, Sequence[str]], cats: Sequence[str]) -> dict:
    out = {k: list(v) for k, v in spec.items()}
    for c in cats:
        out.setdefault(c, []).append("mean")
    return out


def bureau_and_balance(bureau: DataFrame, bb: DataFrame, num_spec=None, key: str = "SK_ID_CURR",
                       bureau_id: str = "SK_ID_BUREAU", month: str = "MONTHS_BALANCE",
                       prefix: str = "BURO_", bb_id: str | None = None, check_size: bool = False):
    """Two-level roll-up: balance rows -> one row per bureau record (joined
    onto the record), then records -> one row per customer.
    Returns ``(aggregate, balance_category_columns)``."""
    num_spec = BUREAU_NUM_SPEC if num_spec is None else num_spec
    bb_id = bb_id or bureau_id
    bb, bb_cat, _ = label_encode(bb, [c for c in _strings(bb) if c != bb_id], check_size=check_size)
    bb_spec = _with_cat_means({month: ["min", "max", "size"]}, bb_cat)
    bb_agg = group_by_key(bb, bb_id, agg_spec(bb_spec)).withColumnRenamed(bb_id, bureau_id)
    bureau, bureau_cat, _ = label_encode(bureau, [c for c in _strings(bureau)
                                                  if c not in (key, bureau_id)], check_size=check_size)
    bureau = bureau.join(bb_agg, bureau_id, "left").drop(bureau_id)
    spec = _with_cat_means(num_spec, list(bureau_cat) + [c + "_MEAN" for c in bb_cat])
    return group_by_key(bureau, key, agg_spec(spec, prefix)), bb_cat


def previous_applications(prev: DataFrame, num_spec=None, key: str = "SK_ID_CURR",
                          sentinel_cols=None, application: str = "AMT_APPLICATION",
                          credit: str = "AMT_CREDIT", prefix: str = "PREV_", check_size: bool = False):
    """Previous applications per customer: sentinel days to missing, the
    asked/received ratio, numeric spec and category-code means."""
    num_spec = PREV_NUM_SPEC if num_spec is None else num_spec
    sentinel_cols = PREV_SENTINEL_COLS if sentinel_cols is None else sentinel_cols
    prev, cats, _ = label_encode(prev, [c for c in _strings(prev) if c != key], check_size=check_size)
    for c in sentinel_cols:
        prev = prev.withColumn(c, sentinel_to_null(c))
    prev = prev.withColumn("APP_CREDIT_PERC", ratio(application, credit))
    return group_by_key(prev, key, agg_spec(_with_cat_means(num_spec, cats), prefix)), cats


def pos_cash(pos: DataFrame, spec=None, key: str = "SK_ID_CURR", prefix: str = "POS_",
             check_size: bool = False):
    """POS balance per customer, with the row count ``POS_COUNT``."""
    spec = POS_SPEC if spec is None else spec
    pos, cats, _ = label_encode(pos, [c for c in _strings(pos) if c != key], check_size=check_size)
    exprs = agg_spec(_with_cat_means(spec, cats), prefix)
    exprs.append(F.count(F.lit(1)).alias(f"{prefix}COUNT"))
    return group_by_key(pos, key, exprs), cats


def installments_payments(ins: DataFrame, spec=None, key: str = "SK_ID_CURR",
                          paid: str = "AMT_PAYMENT", due: str = "AMT_INSTALMENT",
                          paid_day: str = "DAYS_ENTRY_PAYMENT", due_day: str = "DAYS_INSTALMENT",
                          prefix: str = "INSTAL_", check_size: bool = False):
    """Instalments per customer: paid share and difference, days past/before
    due (negative -> 0), with the row count ``INSTAL_COUNT``."""
    spec = INS_SPEC if spec is None else spec
    ins, cats, _ = label_encode(ins, [c for c in _strings(ins) if c != key], check_size=check_size)
    ins = (ins.withColumn("PAYMENT_PERC", ratio(paid, due))
              .withColumn("PAYMENT_DIFF", F.col(due) - F.col(paid))
              .withColumn("DPD", clip_positive(F.col(paid_day) - F.col(due_day)))
              .withColumn("DBD", clip_positive(F.col(due_day) - F.col(paid_day))))
    rows = F.count(F.lit(1)).alias(f"{prefix}COUNT")
    return group_by_spec(ins, key, _with_cat_means(spec, cats), prefix, [rows]), cats


def credit_card_balance(cc: DataFrame, key: str = "SK_ID_CURR", drop=("SK_ID_PREV",),
                        aggs=None, prefix: str = "CC_", check_size: bool = False):
    """Card balance per customer: every remaining column (category codes
    included) x min/max/mean/sum/var, with the row count ``CC_COUNT``."""
    aggs = CC_AGGS if aggs is None else aggs
    cc, cats, _ = label_encode(cc, [c for c in _strings(cc) if c != key], check_size=check_size)
    cc = cc.drop(*[d for d in drop if d in cc.columns])
    spec = {c: list(aggs) for c in cc.columns if c != key}
    exprs = agg_spec(spec, prefix)
    exprs.append(F.count(F.lit(1)).alias(f"{prefix}COUNT"))
    return group_by_key(cc, key, exprs), cats


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]


# Document flags dropped from the application table.
DROPPED_DOC_FLAGS = [
    "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_9",
    "FLAG_DOCUMENT_10", "FLAG_DOCUMENT_11", "FLAG_DOCUMENT_12", "FLAG_DOCUMENT_13",
    "FLAG_DOCUMENT_15", "FLAG_DOCUMENT_17", "FLAG_DOCUMENT_19", "FLAG_DOCUMENT_20",
    "FLAG_DOCUMENT_21",
]
BINARY_FEATURES = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]


def application_train_test(train: DataFrame, test: DataFrame, cfg=None, key: str = "SK_ID_CURR",
                           sentinel_col: str | None = "DAYS_EMPLOYED", binary=None,
                           drop=None, drop_gender_xna: bool = False):
    """Application block: stack train and test (``is_train`` flag), sentinel
    days to missing, derived ratio/row features, first-seen codes for binary
    text features, drop unused document flags, label-encode text and
    two-valued columns.  Returns ``(df, categorical_columns)``."""
    from cohortforge.operators.encode import factorize
    from cohortforge.plans.features import FeatureConfig, application_features
    cfg = cfg or FeatureConfig(key=key)
    binary = BINARY_FEATURES if binary is None else binary
    drop = DROPPED_DOC_FLAGS if drop is None else drop
    df = (train.withColumn("is_train", F.lit(True))
               .unionByName(test.withColumn("is_train", F.lit(False)), allowMissingColumns=True))
    if drop_gender_xna and "CODE_GENDER" in df.columns:
        df = df.filter(F.col("CODE_GENDER").isNull() | (F.col("CODE_GENDER") != "XNA"))
    if sentinel_col and sentinel_col in df.columns:
        df = df.withColumn(sentinel_col, sentinel_to_null(sentinel_col))
    df = application_features(df, cfg)
    # first appearance: train rows before test rows, then key order
    df = df.withColumn("__order", F.when(F.col("is_train"), 0).otherwise(1))
    df = factorize(df, [b for b in binary if b in df.columns], ["__order", key], check_size=True).drop("__order")
    df = df.drop(*[c for c in drop if c in df.columns])
    return encode_application(df, key)


def encode_application(df: DataFrame, key: str):
    """Label-encode (as text, missing ``nan``) the text columns and the
    two-valued columns; the key, the label and ``is_train`` are not features."""
    from cohortforge.operators.encode import label_encode, two_valued_columns
    strings = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    feats = [c for c in df.columns if c not in (key, "TARGET", "is_train")]
    two = set(two_valued_columns(df, [c for c in feats if c not in strings]))
    cats = [c for c in feats if c in strings or c in two]
    enc, _, _ = label_encode(df, cats, "nan", True, check_size=True)
    return enc, cats
