"""The wide feature table: application rows enriched from every history table.

Plan shape (one wide aggregate per history table, by its key):

    app  --derived columns-->  app'
    prev      --groupBy(key)--> totals + means;  counts per (key, value) --> modal categories
    card      --groupBy(key)--> weighted means + mean/sum block + latest order + count, latest row's categories joined back
    bureau    --groupBy(key)--> means + std block + count  --join latest balance row on mean id-->
    pos       --groupBy(key)--> weighted means + latest order + count, latest row's categories joined back
    instal    --groupBy(key)--> means + std block + count
    app' LEFT JOIN each aggregate ON key

All buffers are of fixed width (hash aggregates) where a table names a row id
(``FeatureConfig.*_row_id``); a table without one orders equal months by all
its columns, which sorts.  Histories with latest or modal categories are read
a second time, with the columns for these alone; balance rows are reduced for
the mean ids alone.  The aggregates are hash-partitioned on the key, so the
left joins add no further exchange for them.  Column names follow the merge
order of the source job (suffix on clash), tracked by ``MergeNames``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.functions.rowwise import row_mean, row_sum, with_row_kurtosis, with_row_std
from cohortforge.functions.semantics import ratio, sentinel_to_null
from cohortforge.operators.aggregate import (
    AGGREGATES, agg_name, group_median, is_integral, latest_by, latest_struct, numeric_columns,
    packed_order, string_columns, weighted_mean,
)
from cohortforge.operators.encode import mode_codes
from cohortforge.operators.join import lookup
from cohortforge.plans.naming import MergeNames

# ---------------------------------------------------------------------------
# Derived application features, history specs and suffixes of
# the source job, in their original order.
# ---------------------------------------------------------------------------
REFERENCE_APP_FEATURES = [
    ("ratio", "NEW_CREDIT_TO_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY"),
    ("ratio", "NEW_CREDIT_TO_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    ("kurtosis", "NEW_DOC_IND_KURT", "docs"),
    ("sum", "NEW_LIVE_IND_SUM", "live"),
    ("ratio_plus_one", "NEW_INC_PER_CHLD", "AMT_INCOME_TOTAL", "CNT_CHILDREN"),
    ("group_median", "NEW_INC_BY_ORG", "AMT_INCOME_TOTAL", "ORGANIZATION_TYPE"),
    ("ratio", "NEW_EMPLOY_TO_BIRTH_RATIO", "DAYS_EMPLOYED", "DAYS_BIRTH"),
    ("ratio_plus_one", "NEW_ANNUITY_TO_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("product", "NEW_SOURCES_PROD", "scores"),
    ("row_mean", "NEW_EXT_SOURCES_MEAN", "scores"),
    ("row_std_filled", "NEW_SCORES_STD", "scores"),
    ("ratio", "NEW_CAR_TO_BIRTH_RATIO", "OWN_CAR_AGE", "DAYS_BIRTH"),
    ("ratio", "NEW_CAR_TO_EMPLOY_RATIO", "OWN_CAR_AGE", "DAYS_EMPLOYED"),
    ("ratio", "NEW_PHONE_TO_BIRTH_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    ("ratio", "NEW_PHONE_TO_BIRTH_RATIO_EMPLOYER", "DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    ("ratio", "NEW_CREDIT_TO_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
]
REFERENCE_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
REFERENCE_PREV_TOTALS = [
    ("PREV APP COUNT", "SK_ID_CURR", "count"),
    ("TOTAL PREV LOAN AMT", "AMT_CREDIT", "sum"),
    ("TOTAL_PREV_AMT_ANNUITY", "AMT_ANNUITY", "sum"),
    ("TOTAL_PREV_AMT_APPLICATION", "AMT_APPLICATION", "sum"),
    ("TOTAL_AMT_DOWN_PAYMENT", "AMT_DOWN_PAYMENT", "sum"),
]
REFERENCE_CC_MEAN_SUM = [
    "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT",
    "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT",
    "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT",
    "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE",
    "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT",
    "CNT_DRAWINGS_POS_CURRENT", "CNT_INSTALMENT_MATURE_CUM", "SK_DPD", "SK_DPD_DEF",
]
REFERENCE_BUREAU_STD = [
    "CREDIT_DAY_OVERDUE", "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG", "AMT_CREDIT_SUM",
    "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "AMT_ANNUITY",
]
REFERENCE_POS_WM = ["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"]
REFERENCE_INS_STD = ["DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"]
REFERENCE_SUFFIXES = {
    "prev_mean": "_PAVG", "prev_mode": "_BAVG", "cc_wm": "_CCAVG", "cc_latest": "_CCAVG",
    "bureau_mean": "_BAVG", "bb_latest": "_B_B", "pos_wm": "_CAVG", "pos_latest": "_CAVG",
    "ins_mean": "_IAVG", "cnt_bureau": "_CNT_BUREAU", "cnt_cc": "_CNT_CRED_CARD",
    "cnt_pos": "_CNT_POS_CASH", "cnt_ins": "_CNT_INSTALL",
}


@dataclass
class FeatureConfig:
    """Column names and specs of a wide feature build (defaults: the source job)."""
    key: str = "SK_ID_CURR"
    app_features: list = field(default_factory=lambda: list(REFERENCE_APP_FEATURES))
    score_cols: list = field(default_factory=lambda: list(REFERENCE_SCORES))
    doc_cols: list | None = None      # None: columns whose name holds FLAG_DOC
    live_cols: list | None = None     # None: FLAG_ columns that are not FLAG_DOC / _FLAG_
    median_method: str = "exact"    # exact (distributed) | buffer | sketch
    prev_key: str = "SK_ID_CURR"
    prev_totals: list = field(default_factory=lambda: list(REFERENCE_PREV_TOTALS))
    cc_key: str = "SK_ID_CURR"
    cc_month: str = "MONTHS_BALANCE"
    cc_mean_sum: list = field(default_factory=lambda: list(REFERENCE_CC_MEAN_SUM))
    cc_prefix: str = "BUREAU_"
    bureau_key: str = "SK_ID_CURR"
    bureau_id: str = "SK_ID_BUREAU"
    bureau_std: list = field(default_factory=lambda: list(REFERENCE_BUREAU_STD))
    bureau_prefix: str = "BUREAU_"
    bb_id: str = "SK_ID_BUREAU"
    bb_month: str = "MONTHS_BALANCE"
    pos_key: str = "SK_ID_CURR"
    pos_month: str = "MONTHS_BALANCE"
    # integral columns that tell rows of one key and month apart; bb_row_id is a feature too unless it starts with __ (None: a total order over all columns, by sorting)
    cc_row_id: str | None = None
    bb_row_id: str | None = None
    pos_row_id: str | None = None
    # the latest balance row of the customer's records, instead of the one whose id is the mean of the customer's ids
    bb_by_record: bool = False
    # columns whose sentinel day count becomes missing before anything is derived from them
    app_sentinels: list = field(default_factory=list)
    prev_sentinels: list = field(default_factory=list)
    pos_wm: list = field(default_factory=lambda: list(REFERENCE_POS_WM))
    ins_key: str = "SK_ID_CURR"
    ins_std: list = field(default_factory=lambda: list(REFERENCE_INS_STD))
    ins_prefix: str = "INS_"
    suffixes: dict = field(default_factory=lambda: dict(REFERENCE_SUFFIXES))


def doc_flag_columns(cols) -> list[str]:
    return [c for c in cols if "FLAG_DOC" in c]


def live_flag_columns(cols) -> list[str]:
    return [c for c in cols if "FLAG_" in c and "FLAG_DOC" not in c and "_FLAG_" not in c]


def application_features(app: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Add the derived application columns, in spec order."""
    numeric = set(numeric_columns(app))
    docs = cfg.doc_cols if cfg.doc_cols is not None else doc_flag_columns(app.columns)
    live = cfg.live_cols if cfg.live_cols is not None else live_flag_columns(app.columns)
    live = [c for c in live if c in numeric]      # text flags are left out of the sum
    groups = {"docs": docs, "live": live, "scores": cfg.score_cols}
    out = app
    for spec in cfg.app_features:
        kind, name = spec[0], spec[1]
        if kind == "ratio":
            out = out.withColumn(name, ratio(spec[2], spec[3]))
        elif kind == "ratio_plus_one":
            out = out.withColumn(name, ratio(spec[2], F.lit(1) + F.col(spec[3])))
        elif kind == "kurtosis":
            out = with_row_kurtosis(out, groups[spec[2]], name)
        elif kind == "sum":
            out = out.withColumn(name, row_sum(groups[spec[2]]))
        elif kind == "product":
            cols = groups[spec[2]]
            prod = F.col(cols[0]).cast("double")
            for c in cols[1:]:
                prod = prod * F.col(c)
            out = out.withColumn(name, prod)
        elif kind == "row_mean":
            out = out.withColumn(name, row_mean(groups[spec[2]]))
        elif kind == "row_std_filled":
            out = with_row_std(out, groups[spec[2]], name)
            # global mean of the column, as a lazy scalar subquery over the
            # raw rows (the row std needs no other derived column)
            mean = with_row_std(app.select(*groups[spec[2]]), groups[spec[2]], "__s") \
                .select(F.avg("__s")).scalar()
            out = out.withColumn(name, F.coalesce(F.col(name), mean))
        elif kind == "group_median":
            value, group = spec[2], spec[3]
            med = group_median(app, group, value, "__med", method=cfg.median_method)
            out = (lookup(out, med, group, "__med", "__med_v")
                   .withColumnRenamed("__med_v", name))
        else:
            raise ValueError(f"unknown derived feature kind {kind!r}")
    return out


class _Block:
    """Output columns of one history aggregate: (temp name, base name, suffix)."""

    def __init__(self, tag: str):
        self.tag = tag
        self.exprs: list[Column] = []
        self.parts: list[tuple[list[str], list[str], str | None]] = []
        self.post: list = []

    def part(self, exprs_named: list[tuple[str, Column]], suffix: str | None) -> None:
        temps, bases = [], []
        for i, (base, e) in enumerate(exprs_named):
            t = f"__{self.tag}{len(self.exprs)}"
            self.exprs.append(e.alias(t))
            temps.append(t)
            bases.append(base)
        self.parts.append((temps, bases, suffix))


def _without_sentinels(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: sentinel_to_null(c) for c in cols}) if cols else df


def _rekey(df: DataFrame, child_key: str, key: str) -> DataFrame:
    return df if child_key == key else df.withColumnRenamed(child_key, key)


def _with_latest(agg: DataFrame, child: DataFrame, key: str, month: str, cats: list[str], row_id: str, packed: str, prefix: str) -> DataFrame:
    """The latest row's categories by the packed order that the aggregate has found."""
    rows = child.select(F.col(key).alias("__lk"), packed_order(month, row_id).alias("__lo"), *[F.col(x).alias(f"{prefix}{x}") for x in cats])
    return agg.join(rows, (F.col(key) == F.col("__lk")) & (F.col(packed) == F.col("__lo")), "left").drop("__lk", "__lo", packed)


def balance_columns(bb: DataFrame, bb_id: str, row_id: str | None) -> list[str]:
    """The balance columns that become features: all but the id, and but a row id named with a leading ``__``."""
    return [c for c in bb.columns if c != bb_id and not (c == row_id and c.startswith("__"))]


def latest_of_records(bureau: DataFrame, bb: DataFrame, key: str, bureau_id: str, bb_id: str, month: str,
                      row_id: str | None = None) -> DataFrame:
    """Per customer, the latest balance row of all its bureau records: ``(key, bb_id, other balance columns)``.

    Each record is reduced to its latest row first, then the customer's
    records to the one with the latest month (ties: the largest record id).
    Customers without balance rows have no row.
    """
    cols = balance_columns(bb, bb_id, row_id)
    per_record = latest_by(bb, bb_id, month, cols, cols, row_id)
    owners = bureau.select(F.col(key), F.col(bureau_id).alias("__owned")).filter(F.col(key).isNotNull()).distinct()
    rows = owners.join(per_record, F.col("__owned") == F.col(bb_id)).drop("__owned")
    return latest_by(rows, key, month, [bb_id, *cols], row_id=bb_id)


def feature_engineering(app: DataFrame, bureau: DataFrame, bb: DataFrame, cc: DataFrame,
                        pos: DataFrame, prev: DataFrame, ins: DataFrame,
                        cfg: FeatureConfig | None = None) -> DataFrame:
    """One row per application row, with every history block joined on."""
    cfg = cfg or FeatureConfig()
    k, sx = cfg.key, cfg.suffixes
    left = application_features(_without_sentinels(app, cfg.app_sentinels), cfg)
    names = MergeNames(left.columns)
    aggs: list[tuple[DataFrame, list]] = []

    # previous applications: totals, means, modal category codes
    p = _rekey(_without_sentinels(prev, cfg.prev_sentinels), cfg.prev_key, k)
    pb = _Block("p")
    pb.part([(n, AGGREGATES[fn](F.col(c))) for n, c, fn in cfg.prev_totals], None)
    pb.part([(c, AGGREGATES["mean"](F.col(c))) for c in numeric_columns(p, [k])], sx["prev_mean"])
    p_cats = string_columns(p, [k])
    p_agg = p.filter(F.col(k).isNotNull()).groupBy(k).agg(*pb.exprs)
    pb.parts.append(([f"__pm_{c}" for c in p_cats], p_cats, sx["prev_mode"]))
    if p_cats:
        modes = mode_codes(p, k, p_cats)
        p_agg = p_agg.join(modes.select(F.col(k).alias("__mk"), *[F.col(c).alias(f"__pm_{c}") for c in p_cats]), F.col(k) == F.col("__mk"), "left").drop("__mk")
    aggs.append((p_agg, pb.parts))

    # card balance: weighted means, mean/sum block, latest categories, count
    c = _rekey(cc, cfg.cc_key, k)
    cb = _Block("c")
    c_num = numeric_columns(c, [k])
    cb.part([(x, weighted_mean(x, cfg.cc_month)) for x in c_num], sx["cc_wm"])
    cb.part([(agg_name(cfg.cc_prefix, x, a), AGGREGATES[a](F.col(x)))
             for x in cfg.cc_mean_sum for a in ("mean", "sum")], None)
    c_cats = string_columns(c, [k])
    c_tie = [x for x in c.columns if x not in (k, cfg.cc_month)]
    c_packed = cfg.cc_row_id is not None and is_integral(c, cfg.cc_month, cfg.cc_row_id)
    if c_cats:
        cb.part([("__latest", F.max(packed_order(cfg.cc_month, cfg.cc_row_id)) if c_packed
                  else latest_struct(cfg.cc_month, c_cats, c_tie))], None)
    cb.part([(k, F.count(F.lit(1)))], sx["cnt_cc"])
    c_agg = c.filter(F.col(k).isNotNull()).groupBy(k).agg(*cb.exprs)
    if c_cats:
        latest_t = cb.parts[2][0][0]
        c_agg = _with_latest(c_agg, c, k, cfg.cc_month, c_cats, cfg.cc_row_id, latest_t, "__cl_") if c_packed else c_agg.select("*", *[F.col(f"{latest_t}.{x}").alias(f"__cl_{x}") for x in c_cats]
                             ).drop(latest_t)
        cb.parts[2] = ([f"__cl_{x}" for x in c_cats], c_cats, sx["cc_latest"])
    aggs.append((c_agg, cb.parts))

    # bureau: means, std block, count; then the latest balance row on the mean id
    b = _rekey(bureau, cfg.bureau_key, k)
    bbk = _Block("b")
    b_num = numeric_columns(b, [k])
    bbk.part([(x, AGGREGATES["mean"](F.col(x))) for x in b_num], sx["bureau_mean"])
    bbk.part([(agg_name(cfg.bureau_prefix, x, a), AGGREGATES[a](F.col(x)))
              for x in cfg.bureau_std for a in ("std", "mean", "sum")], None)
    bbk.part([(k, F.count(F.lit(1)))], sx["cnt_bureau"])
    b_agg = b.filter(F.col(k).isNotNull()).groupBy(k).agg(*bbk.exprs)
    mean_id_temp = bbk.parts[0][0][b_num.index(cfg.bureau_id)]
    bb_cols = balance_columns(bb, cfg.bb_id, cfg.bb_row_id)
    if cfg.bb_by_record:
        latest_bb = latest_of_records(b, bb, k, cfg.bureau_id, cfg.bb_id, cfg.bb_month, cfg.bb_row_id).withColumnRenamed(k, "__bbk")
        on = F.col(k) == F.col("__bbk")
    else:
        # only balance rows of ids that are some customer's mean id are reduced
        mean_ids = b_agg.select(F.col(mean_id_temp).alias("__m")).filter("__m = floor(__m)").select(F.col("__m").cast("long").alias("__id")).distinct()
        wanted = bb.join(mean_ids, F.col(cfg.bb_id) == F.col("__id"), "left_semi")
        # the semi join has shuffled and sorted them by that id: one aggregate over structs, where a join back would shuffle all balance rows again
        tie = list(dict.fromkeys([*([cfg.bb_row_id] if cfg.bb_row_id else []), *bb_cols]))
        latest_bb = (latest_by(wanted, cfg.bb_id, cfg.bb_month, bb_cols, tie)
                     .withColumn("__bbk", F.col(cfg.bb_id).cast("double")))
        on = F.col(mean_id_temp) == F.col("__bbk")
    latest_bb = latest_bb.select("__bbk", F.col(cfg.bb_id).alias("__bbid"), *[F.col(x).alias(f"__bl_{x}") for x in bb_cols])
    b_agg = b_agg.join(latest_bb, on, "left").drop("__bbk")
    aggs.append((b_agg, bbk.parts))
    bb_part = (["__bbid"] + [f"__bl_{x}" for x in bb_cols], [cfg.bb_id] + bb_cols, sx["bb_latest"])

    # POS balance: weighted means, latest categories, count
    q = _rekey(pos, cfg.pos_key, k)
    qb = _Block("q")
    qb.part([(x, weighted_mean(x, cfg.pos_month)) for x in cfg.pos_wm], sx["pos_wm"])
    q_cats = string_columns(q, [k])
    q_tie = [x for x in q.columns if x not in (k, cfg.pos_month)]
    q_packed = cfg.pos_row_id is not None and is_integral(q, cfg.pos_month, cfg.pos_row_id)
    if q_cats:
        qb.part([("__latest", F.max(packed_order(cfg.pos_month, cfg.pos_row_id)) if q_packed
                  else latest_struct(cfg.pos_month, q_cats, q_tie))], None)
    qb.part([(k, F.count(F.lit(1)))], sx["cnt_pos"])
    q_agg = q.filter(F.col(k).isNotNull()).groupBy(k).agg(*qb.exprs)
    if q_cats:
        latest_t = qb.parts[1][0][0]
        q_agg = _with_latest(q_agg, q, k, cfg.pos_month, q_cats, cfg.pos_row_id, latest_t, "__ql_") if q_packed else q_agg.select("*", *[F.col(f"{latest_t}.{x}").alias(f"__ql_{x}") for x in q_cats]
                             ).drop(latest_t)
        qb.parts[1] = ([f"__ql_{x}" for x in q_cats], q_cats, sx["pos_latest"])
    aggs.append((q_agg, qb.parts))

    # instalments: means, std block, count
    i = _rekey(ins, cfg.ins_key, k)
    ib = _Block("i")
    ib.part([(x, AGGREGATES["mean"](F.col(x))) for x in numeric_columns(i, [k])], sx["ins_mean"])
    ib.part([(agg_name(cfg.ins_prefix, x, a), AGGREGATES[a](F.col(x)))
             for x in cfg.ins_std for a in ("std", "mean", "sum")], None)
    ib.part([(k, F.count(F.lit(1)))], sx["cnt_ins"])
    i_agg = i.filter(F.col(k).isNotNull()).groupBy(k).agg(*ib.exprs)
    aggs.append((i_agg, ib.parts))

    # names, in the merge order of the source job (the counts come last)
    final: list[tuple[str, str]] = []          # (temp, final name)

    def take(part):
        temps, bases, suffix = part
        for t, n in zip(temps, names.add(bases, suffix)):
            final.append((t, n))

    p_parts, c_parts, b_parts, q_parts, i_parts = (a[1] for a in aggs)
    for part in p_parts:
        take(part)
    for part in c_parts[:-1]:
        take(part)
    for part in b_parts[:-1]:
        take(part)
    # the latest balance row joins on the bureau mean id: one key column when
    # both sides use one name, both columns otherwise
    mean_id_name = dict(final)[mean_id_temp]
    if mean_id_name == cfg.bb_id and not cfg.bb_by_record:
        take((bb_part[0][1:], bb_part[1][1:], bb_part[2]))
    else:
        take(bb_part)
    for part in q_parts[:-1]:
        take(part)
    for part in i_parts[:-1]:
        take(part)
    for parts in (b_parts, c_parts, q_parts, i_parts):
        take(parts[-1])

    out = left
    for agg_df, _ in aggs:
        out = out.join(agg_df, k, "left")
    left_cols = [F.col(f"`{c}`").alias(names.renamed_left.get(c, c)) for c in left.columns]
    return out.select(*left_cols, *[F.col(f"`{t}`").alias(n) for t, n in final])
