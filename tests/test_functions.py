"""Golden rows for the column expressions: missing values, zero divisors, row statistics."""

import math

import pandas as pd
import pytest

from cohortforge.functions import (
    as_text, clip_positive, nan_to_null, psum, ratio, replace_inf, row_kurtosis, row_mean,
    row_std, row_sum, sentinel_to_null, with_row_kurtosis, with_row_std,
)


def test_ratio_signs_and_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-2.0, 0.0), (0.0, 0.0), (None, 0.0), (6.0, 3.0),
                                (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(ratio("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf
    assert got[2] is None and got[3] is None and got[5] is None
    assert got[4] == 2.0
    filled = [r[0] for r in df.select(replace_inf(ratio("a", "b"))).collect()]
    assert filled[:2] == [999.0, -999.0]


def test_nan_sentinel_clip_text(spark):
    df = spark.createDataFrame([(float("nan"), 365243, -1.0, 10.0), (2.0, 5, 3.0, None)],
                               "x double, d long, c double, t double")
    rows = df.select(nan_to_null("x"), sentinel_to_null("d"), clip_positive("c"),
                     as_text("t")).collect()
    assert rows[0][0] is None and rows[0][1] is None and rows[0][2] == 0.0 and rows[0][3] == "10.0"
    assert rows[1][0] == 2.0 and rows[1][1] == 5 and rows[1][2] == 3.0 and rows[1][3] == "nan"


def test_psum_all_missing_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "k int, v double")
    got = dict(df.groupBy("k").agg(psum("v").alias("s")).collect())
    assert got == {1: 0.0, 2: 3.0}


ROWS = [(1.0, 1.0, 1.0, 1.0), (1.0, 0.0, 1.0, None), (0.0, 1.0, 0.0, 1.0),
        (0.0, None, None, None), (None, None, None, None), (2.0, 5.0, 1.0, 9.0)]


def test_row_stats_match_pandas(spark):
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(ROWS, ", ".join(f"{c} double" for c in cols))
    pdf = pd.DataFrame(ROWS, columns=cols)
    out = with_row_kurtosis(with_row_std(df, cols, "std2"), cols, "kurt2").select(
        row_mean(cols).alias("mean"), row_std(cols).alias("std"), row_sum(cols).alias("sum"),
        row_kurtosis(cols).alias("kurt"), "std2", "kurt2").toPandas()
    exp_mean, exp_std = pdf.mean(axis=1), pdf.std(axis=1)
    exp_sum, exp_kurt = pdf.sum(axis=1), pdf.kurtosis(axis=1)
    for got, exp in ((out["mean"], exp_mean), (out["std"], exp_std), (out["std2"], exp_std),
                     (out["sum"], exp_sum), (out["kurt"], exp_kurt), (out["kurt2"], exp_kurt)):
        for g, e in zip(got, exp):
            if pd.isna(e):
                assert pd.isna(g)
            else:
                assert g == pytest.approx(e, rel=1e-9, abs=1e-12)
    assert out["kurt"][0] == 0.0        # four equal values
    assert pd.isna(out["kurt"][1])      # three values
