"""End-to-end jobs on tiny reference-shaped CSV inputs written to a scratch folder."""

import os
import random
import tempfile


from cohortforge.plans import jobs
from cohortforge.sources import schemas


def _write_inputs(spark, folder):
    rnd = random.Random(7)
    n = 40

    def rows(schema, count, key_fn):
        out = []
        for i in range(count):
            r = {}
            for f in schema.fields:
                t = f.dataType.typeName()
                if t == "string":
                    r[f.name] = rnd.choice(["A", "B", None])
                elif t == "double":
                    r[f.name] = rnd.choice([rnd.uniform(-5, 5), None])
                else:
                    r[f.name] = rnd.randint(-30, -1)
            r.update(key_fn(i))
            out.append(r)
        return spark.createDataFrame(out, schema)

    tables = {
        "application_train": rows(schemas.APPLICATION, n, lambda i: {"SK_ID_CURR": i, "TARGET": i % 2}),
        "application_test": rows(schemas.APPLICATION, 10, lambda i: {"SK_ID_CURR": 1000 + i,
                                                                     "TARGET": None}),
        "bureau": rows(schemas.BUREAU, 80, lambda i: {"SK_ID_CURR": i % n, "SK_ID_BUREAU": i}),
        "bureau_balance": rows(schemas.BUREAU_BALANCE, 200, lambda i: {"SK_ID_BUREAU": i % 80}),
        "credit_card_balance": rows(schemas.CREDIT_CARD_BALANCE, 120,
                                    lambda i: {"SK_ID_CURR": i % n, "SK_ID_PREV": i % 30}),
        "POS_CASH_balance": rows(schemas.POS_CASH_BALANCE, 120,
                                 lambda i: {"SK_ID_CURR": i % n, "SK_ID_PREV": i % 30}),
        "previous_application": rows(schemas.PREVIOUS_APPLICATION, 90,
                                     lambda i: {"SK_ID_CURR": i % n, "SK_ID_PREV": i}),
        "installments_payments": rows(schemas.INSTALLMENTS_PAYMENTS, 150,
                                      lambda i: {"SK_ID_CURR": i % n, "SK_ID_PREV": i % 90}),
    }
    for name, df in tables.items():
        pdf = df.toPandas()
        pdf = pdf[rnd.sample(list(pdf.columns), len(pdf.columns))]      # files come in any column order
        if name == "application_test":
            pdf = pdf.drop(columns="TARGET")
        if name.startswith("application"):
            pdf["NAME_CONTRACT_TYPE"] = "Cash loans"
            for k in (3, 5, 6, 8, 14):
                pdf[f"FLAG_DOCUMENT_{k}"] = [(i + k) % 2 for i in range(len(pdf))]
            pdf["FLAG_MOBIL"] = 1
            pdf.loc[0, "OCCUPATION_TYPE"] = f"only here in {name}"       # a category of one fold
        pdf.to_csv(os.path.join(folder, name + ".csv"), index=False)


def test_build_train_submit(spark):
    folder = tempfile.mkdtemp(prefix="cf-jobs-")
    _write_inputs(spark, folder)
    wide = jobs.build_features(spark, folder, os.path.join(folder, "features"))
    assert wide.count() == 50
    assert "NEW_CREDIT_TO_ANNUITY_RATIO" in wide.columns and "SK_ID_CURR_CNT_INSTALL" in wide.columns
    assert "PREV APP COUNT" in wide.columns and "SK_ID_BUREAU" in wide.columns
    assert "NAME_CONTRACT_TYPE_BAVG" in wide.columns
    row = wide.selectExpr("min(NEW_LIVE_IND_SUM)", "count(NEW_DOC_IND_KURT)").first()
    assert row[0] > 0 and row[1] == 50
    oof, fold_auc, overall = jobs.train(spark, os.path.join(folder, "features"),
                                        os.path.join(folder, "out"), k=5, max_iter=5)
    assert spark.read.parquet(os.path.join(folder, "out", "encoder")).where("column = 'STATUS'").count() > 0
    assert oof.count() == 40 and fold_auc.count() == 5
    # encoder and scaler that learn from the training rows alone
    wide = spark.read.parquet(os.path.join(folder, "features")).select("SK_ID_CURR", "TARGET", "is_train", "OCCUPATION_TYPE", "EXT_SOURCE_1", "AMT_CREDIT")
    df, numeric, cats, _ = jobs.prepare(wide, encode=[], codes_path=os.path.join(folder, "train_codes"), fit_on="is_train")
    codes = spark.read.parquet(os.path.join(folder, "train_codes")).where("column = 'OCCUPATION_TYPE'")
    assert "only here in application_test" not in {r.value for r in codes.collect()}
    rows = {r.SK_ID_CURR: r for r in df.collect()}
    assert cats == ["OCCUPATION_TYPE"] and rows[1000].OCCUPATION_TYPE == codes.count()
    assert abs(sum(r.AMT_CREDIT for r in rows.values() if r.is_train)) < 1e-9
    template = spark.createDataFrame([(1000 + i, 0.5) for i in range(10)], "SK_ID_CURR long, TARGET double")
    sub = jobs.submit(spark, os.path.join(folder, "out"), template, k=5)
    got = sub.collect()
    assert len(got) == 10 and all(0 <= r["TARGET"] <= 1 for r in got)
