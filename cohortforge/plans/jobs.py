"""The three jobs of the source pipeline as functions: build, train, submit.

    build_features(spark, input_dir, out)      8 source tables -> wide feature table
    train(spark, features, out_dir)            encode, prune, fill, scale, k-fold fit,
                                               out-of-fold scores and AUC, test matrix
    submit(spark, out_dir, template)           score test rows with every fold model,
                                               one submission per fold + the averaged one

Files are the boundaries between jobs (Parquet; CSV where asked).  Sample
runs read the first ``sample_size`` rows in key order and write under
``rubbish`` subfolders.  The encoded training frame is checkpointed to the
session's checkpoint folder before the fold loop, so the k fits share one
materialised copy and a lost executor costs a re-read, not a recompute of
the whole feature plan.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.operators.encode import label_encode, save_codes
from cohortforge.operators.folds import hash_folds, stratified_folds
from cohortforge.operators.join import kept_tables
from cohortforge.operators.metrics import auc_exact
from cohortforge.operators.model import ensemble_mean, fit_folds, load_models, score_folds
from cohortforge.operators.profile import fill_missing, prune_null_columns, replace_inf_all
from cohortforge.operators.stages import CategoryEncoder, ColumnScaler
from cohortforge.plans.features import FeatureConfig, feature_engineering
from cohortforge.session import checkpoint_dir
from cohortforge.sources.layout import layout_of, read_stored, write_bucketed
from cohortforge.sources.io import (
    output_dir, read_inputs, read_table, sample_scan, write_submission, write_table,
)

# The columns that the trainer encodes besides all text columns.
ENCODER_COLUMNS = [
    "FONDKAPREMONT_MODE", "HOUR_APPR_PROCESS_START", "HOUSETYPE_MODE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "WALLSMATERIAL_MODE",
    "WEEKDAY_APPR_PROCESS_START", "NAME_CONTRACT_TYPE_BAVG", "WEEKDAY_APPR_PROCESS_START_BAVG", "NAME_CASH_LOAN_PURPOSE",
    "NAME_CONTRACT_STATUS", "NAME_PAYMENT_TYPE", "CODE_REJECT_REASON", "NAME_TYPE_SUITE_BAVG", "NAME_CLIENT_TYPE",
    "NAME_GOODS_CATEGORY", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE", "CHANNEL_TYPE", "NAME_SELLER_INDUSTRY", "NAME_YIELD_GROUP",
    "PRODUCT_COMBINATION", "NAME_CONTRACT_STATUS_CCAVG", "STATUS", "NAME_CONTRACT_STATUS_CAVG"]

META_COLS = ["SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV"]


def build_features(spark: SparkSession, input_dir: str, out: str | None = None,
                   fmt: str = "csv", sample_size: int | None = None,
                   cfg: FeatureConfig | None = None, out_fmt: str = "parquet", buckets: int | None = None) -> DataFrame:
    """Stack train and test applications, enrich them from every history
    table, and write the wide table (only for full runs, as the source job),
    in ``buckets`` buckets on the key if given."""
    cfg = cfg or FeatureConfig()
    t = read_inputs(spark, input_dir, fmt)
    k = cfg.key
    train = sample_scan(t["application_train"], sample_size, k)
    test = sample_scan(t["application_test"], sample_size, k)
    app = (train.withColumn("is_train", F.lit(True))
                .unionByName(test.withColumn("is_train", F.lit(False)), allowMissingColumns=True))
    hist = {n: sample_scan(t[n], sample_size, [c for c in t[n].columns if c.startswith("SK_ID")])
            for n in ("bureau", "bureau_balance", "credit_card_balance", "POS_CASH_balance",
                      "previous_application", "installments_payments")}
    wide = feature_engineering(app, hist["bureau"], hist["bureau_balance"],
                               hist["credit_card_balance"], hist["POS_CASH_balance"],
                               hist["previous_application"], hist["installments_payments"], cfg)
    if out and sample_size is None:
        if buckets:
            return write_bucketed(wide, out, k, buckets)
        write_table(wide, out, out_fmt)
    return wide


def prepare(features: DataFrame, label: str = "TARGET", key: str = "SK_ID_CURR",
            null_threshold: float = 0.8, encode: Sequence[str] = ENCODER_COLUMNS, codes_path: str | None = None,
            fit_on: str | None = None):
    """Encode text columns and those named in ``encode`` (one that is not there is an error), prune
    mostly-missing columns, fill, cap infinities, scale.  ``codes_path``: where the encoder's dictionary goes.
    ``fit_on``: a condition on the rows (``"is_train"``) that encoder and scaler learn from, instead of all;
    values that the encoder did not learn get the code after the last."""
    absent = [c for c in encode if c not in features.columns]
    if absent:
        raise ValueError(f"columns to encode that the features lack: {', '.join(absent)}")
    meta = [c for c in META_COLS if c in features.columns and c != key]
    df = features.drop(*meta)
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    text += [c for c in encode if c not in text]
    if fit_on and text:
        encoder = CategoryEncoder(cols=text, fitOn=fit_on, missing="nan", asText=True).fit(df)
        df, cats, codes = encoder.transform(df), text, encoder.table
    else:
        df, cats, codes = label_encode(df, text, missing="nan", as_string=True)
    if codes_path and codes is not None:
        save_codes(codes, codes_path)
    df, dropped = prune_null_columns(df, null_threshold, protect=[key, label, "is_train"])
    cats = [c for c in cats if c not in dropped]
    df = replace_inf_all(fill_missing(df, 0, [c for c in df.columns if c not in (label,)]))
    numeric = [c for c in df.columns if c not in set(cats) | {key, label, "is_train"}]
    df = ColumnScaler(cols=numeric, fitOn=fit_on or "").fit(df).transform(df)
    return df, numeric, cats, dropped


def train(spark: SparkSession, features: DataFrame | str, out_dir: str, k: int = 5,
          kind: str = "mlp", max_iter: int = 30, stratified: bool = True,
          key: str = "SK_ID_CURR", label: str = "TARGET", sample_size: int | None = None,
          encode: Sequence[str] = ENCODER_COLUMNS, fit_on: str | None = None, buckets: int | None = None):
    """k-fold training; returns (oof_scores, fold_auc, overall_auc).  With ``buckets`` the test matrix is
    written in that many buckets on the key, and ``submit`` joins it to the template without an exchange."""
    out_dir = output_dir(out_dir, sample_size)
    if isinstance(features, str):
        features = read_stored(spark, features)
    if sample_size is not None:     # n training rows, and n test rows: 2n in all
        features = sample_scan(features.filter("is_train"), sample_size, key).unionByName(
            sample_scan(features.filter("not is_train"), sample_size, key))
    checkpoint_dir(spark)
    with kept_tables():
        df, numeric, cats, _ = prepare(features, label, key, encode=encode, codes_path=os.path.join(out_dir, "encoder"), fit_on=fit_on)
        df = df.checkpoint(eager=True)             # one materialised copy for all fits
    matrix, at = df.filter(~F.col("is_train")).drop(label), os.path.join(out_dir, "test_matrix")
    if buckets:
        write_bucketed(matrix, at, key, buckets)
    else:
        write_table(matrix, at)
    tr = df.filter(F.col("is_train"))
    tr = (stratified_folds(tr, label, key, k) if stratified else hash_folds(tr, key, k, 2018))
    oof, _ = fit_folds(tr, key, numeric, cats, label, "fold", k, kind, max_iter,
                       model_dir=os.path.join(out_dir, "models"))
    write_table(oof, os.path.join(out_dir, "oof"))      # scored once; all that follows reads it
    oof = read_table(spark, os.path.join(out_dir, "oof"))
    return oof, auc_exact(oof, label, "score", by=["fold"]), auc_exact(oof, label, "score")


def submit(spark: SparkSession, out_dir: str, template: DataFrame, k: int = 5,
           key: str = "SK_ID_CURR", sample_size: int | None = None) -> DataFrame:
    """Score the saved test matrix with every fold model; write one file per
    fold and the averaged one (scores matched to the template by key)."""
    out_dir = output_dir(out_dir, sample_size)
    template = sample_scan(template, sample_size, key)
    at = os.path.join(out_dir, "test_matrix")
    test, found = read_stored(spark, at), layout_of(spark, at)
    if found:           # the template meets the scores k + 1 times: shuffled once, when it is stored
        template = write_bucketed(template, os.path.join(out_dir, "template"), *found)
    scores = score_folds(load_models(os.path.join(out_dir, "models"), k), test, key)
    for f in range(k):
        write_submission(template, scores.filter(F.col("fold") == f)
                         .select(key, F.col("score").alias("TARGET")), key,
                         os.path.join(out_dir, f"fold_{f + 1}_submission"))
    avg = ensemble_mean(scores, key)
    return write_submission(template, avg, key, os.path.join(out_dir, f"avg_{k}_folds_submission"))
