"""Registered queries over the test tables, each with its DuckDB oracle.

Every query reads the given Parquet tables (or tables Spark derives from them) in

Queries that involve a trained model run the library's training job on 0/1 features, at
settings whose result has a closed form that SQL can compute:
* logistic regression on one 0/1 feature: intercept = logit(r0), slope = logit(r1) - logit(r0);
* one unbootstrapped depth-1 tree on a 0/1 feature: leaf probability = group rate;
* one boosting round of depth 1: probability = 1 / (1 + exp(-2 (2r - 1)));
* a single-split tree puts importance 1.0 on the feature with the larger variance gain;
* on one 0/1 feature the AUC of any score that rises with it is (1 + tpr - fpr) / 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import RISK_ROWS_CATALOG
from riskloom.functions.formatting import percent_text, thousands_text
from riskloom.functions.local import local_frame
from riskloom.operators import evaluate as ev
from riskloom.operators import explain as ex
from riskloom.operators import profile as pf
from riskloom.operators import quality as q
from riskloom.operators.features import SCALED, assembler, fit_scaler, scaler_stats, vector_columns
from riskloom.operators.models import cross_validate, pipeline_model, reference_grids
from riskloom.operators.profile_states import current_states, merged_description, merged_labels, update_profile
from riskloom.operators.score import linear_probability, positive_probability, score_with_rejects, verdicts
from riskloom.operators.select import auc_percent, select_winner
from riskloom.operators.split import fold_assignment, hash_split
from riskloom.operators.tree_score import read_trees, score_trees
from riskloom.plans.fixture_runs import closed_catalog, closed_run, keyless_run, model_dir
from riskloom.plans.score_job import score_job, score_to
from riskloom.session import drop_scratch, input_state
from riskloom.sources import fixtures as fx
from riskloom.sources import registry
from riskloom.sources.lines import classify_lines
from riskloom.sources.tables import records_from_json, zip_features_target
from riskloom.sources.tables import scan_training as scan_training_path
from riskloom.streaming.score_stream import read_sink, run_to_completion, score_stream_once

CAT = RISK_ROWS_CATALOG
FEATS = fx.RISK_FEATURES
KEY = "row_key"
RISK = "WITH " + fx.RISK_ROWS_SQL

EVAL_SCORE_SQL = "(qty * 2 + discount_pct * 3)"
EVAL_CUT = 110
# Fixed (not trained) logistic coefficients for the SQL form of a linear model.
LINEAR_COEFS = {"qty": 0.12, "discount_pct": 0.3, "is_returned": 1.1}
LINEAR_INTERCEPT = -6.5
HI_SCORE_SQL = f"CAST({fx.FLAGS['hi_score']} AS INTEGER)"
ONE, TWO, ALL = ("hi_score",), ("hi_score", "is_returned"), tuple(fx.FLAGS)


def eval_score():
    """Integer score both engines compute identically (input of the evaluation operators)."""
    return F.col("qty") * 2 + F.col("discount_pct") * 3


def _rr(spark: SparkSession, sf: str) -> DataFrame:
    """risk_rows as a plan: each query reads of the given tables what it uses."""
    return fx.risk_rows(spark, sf)


def _train(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split_bucket") < fx.TRAIN_PERCENT)


def _test(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split_bucket") >= fx.TRAIN_PERCENT)


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """risk_rows with planted gaps: discount 0 → null, qty 50 → null, line 7 → NaN price."""
    df = _rr(spark, sf)
    return (df.withColumn("discount_pct", F.when(F.col("discount_pct") != 0, F.col("discount_pct")))
            .withColumn("qty", F.when(F.col("qty") != 50, F.col("qty")))
            .withColumn("price", F.when(F.col("line_no") == 7, F.lit(float("nan"))).otherwise(F.col("price"))))


GAPS_SQL = RISK + """,
gaps AS (
  SELECT * REPLACE (
    CASE WHEN discount_pct <> 0 THEN discount_pct END AS discount_pct,
    CASE WHEN qty <> 50 THEN qty END AS qty,
    CASE WHEN line_no = 7 THEN CAST('NaN' AS DOUBLE) ELSE price END AS price)
  FROM risk_rows
)"""
GAP_COLS = ["qty", "discount_pct", "price"]


# ----------------------------------------------------------------------------- sources
def scan_training(spark, sf):
    """Read the modelling table from its path and project it onto the catalog."""
    fx.risk_rows_table(spark, sf)
    return scan_training_path(spark, fx.risk_rows_path(spark, sf), CAT)


SQL_SCAN_TRAINING = RISK + " SELECT row_key, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS) + ", CAST(label AS DOUBLE) AS label FROM risk_rows"


def zip_features_target_q(spark, sf):
    labels = fx.table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return zip_features_target(fx.doc_features(spark, sf), labels, ["doc_id"])


SQL_ZIP = "WITH " + fx.DOC_QUALITY_SQL + " SELECT * FROM doc_quality"


def records_from_json_q(spark, sf):
    ev_df = fx.table(spark, sf, "events")
    return records_from_json(ev_df, "props", "k INT", keep=["event_id", "event_type"])


SQL_RECORDS = ("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k "
               "FROM events")


def _written_lines(spark, sf) -> DataFrame:
    """All rows as lines of JSON and of CSV, with faults planted by order line."""
    rows = fx.flag_rows(spark, sf, ONE)
    record = F.to_json(F.struct(KEY, F.when(F.col("quantity") != 50, F.col("hi_score")).alias("hi_score")))
    line = F.split_part(F.col(KEY), F.lit("|"), F.lit(5))
    fields = F.concat_ws(",", KEY, F.when(F.col("quantity") != 50, F.col("hi_score").cast("string")).otherwise(""))
    json_line = (F.when(line == "7", F.concat(F.lit("cut off "), record)).when(line == "6", F.lit("[1, 2]"))
                 .when(line == "5", F.lit("  ")).otherwise(record))
    csv_line = (F.when(line == "7", F.concat(fields, F.lit(",9,9"))).when(line == "6", F.col(KEY))
                .when(line == "5", F.concat(F.lit('"'), fields)).otherwise(fields))
    return rows.select(F.explode(F.array(F.struct(F.lit("json").alias("fmt"), json_line.alias("line")),
                                         F.struct(F.lit("csv").alias("fmt"), csv_line.alias("line")))).alias("l")).select("l.*")


def corrupt_records(spark, sf):
    """Lines that are no record, with reasons; of the others how many can be scored and how many lack a feature."""
    lines, catalog = _written_lines(spark, sf), closed_catalog(ONE)
    parts = []
    for fmt in ("json", "csv"):
        classified = classify_lines(lines.filter(F.col("fmt") == fmt).drop("fmt"), catalog, fmt, [KEY, *ONE])
        no_feature = F.col("record")["hi_score"].try_cast("double").isNull()
        what = F.coalesce("reason", F.when(no_feature, "rejected").otherwise("scored"))
        parts.append(classified.groupBy(F.lit(fmt).alias("fmt"), what.alias("what")).agg(
            F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("characters")))
    return parts[0].unionByName(parts[1])


SQL_CORRUPT = RISK + f""",
r AS (SELECT CAST(split_part(row_key, '|', 5) AS INTEGER) AS line, qty, row_key, CASE WHEN qty <> 50 THEN {HI_SCORE_SQL} END AS x FROM risk_rows),
j AS (SELECT line, qty, row_key, '{{"row_key":"' || row_key || '"' || CASE WHEN x IS NULL THEN '' ELSE ',"hi_score":' || x END || '}}' AS record,
             row_key || ',' || coalesce(CAST(x AS VARCHAR), '') AS fields FROM r),
l AS (SELECT 'json' AS fmt, CASE line WHEN 7 THEN 'not_json' WHEN 6 THEN 'not_an_object' WHEN 5 THEN 'empty' END AS reason, qty,
             CASE line WHEN 7 THEN 'cut off ' || record WHEN 6 THEN '[1, 2]' WHEN 5 THEN '  ' ELSE record END AS line FROM j
      UNION ALL
      SELECT 'csv', CASE line WHEN 7 THEN 'too_many_fields' WHEN 6 THEN 'too_few_fields' WHEN 5 THEN 'open_quote' END, qty,
             CASE line WHEN 7 THEN fields || ',9,9' WHEN 6 THEN row_key WHEN 5 THEN '"' || fields ELSE fields END FROM j)
SELECT fmt, coalesce(reason, CASE WHEN qty = 50 THEN 'rejected' ELSE 'scored' END) AS what, count(*) AS lines,
       CAST(sum(length(line)) AS BIGINT) AS characters
FROM l GROUP BY ALL"""


# ----------------------------------------------------------------------------- profile
def split_counts(spark, sf):
    return pf.split_counts(hash_split(_rr(spark, sf), bucket_col="split_bucket"), "part", "label")


SQL_SPLIT_COUNTS = RISK + """,
p AS (SELECT CASE WHEN split_bucket < 80 THEN 'train' ELSE 'test' END AS part, label FROM risk_rows)
SELECT part, count(*) AS rows, sum(label) AS positives FROM p GROUP BY part
UNION ALL SELECT 'all', count(*), sum(label) FROM p"""


def schema_report(spark, sf):
    rep = pf.schema_report(spark, _rr(spark, sf), with_counts=True)
    return rep.select("ordinal", "column_name", "data_type", "non_null_rows")


_RISK_COLUMNS = ["row_key", *FEATS, "split_bucket", "fold", "label"]
# DuckDB type names → Spark's simple type names (the only types risk_rows carries).
_SPARK_TYPE = "CASE {t} WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' " \
              "WHEN 'VARCHAR' THEN 'string' ELSE lower({t}) END"
SQL_SCHEMA_REPORT = RISK + " " + " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS column_name, {_SPARK_TYPE.format(t=f'any_value(typeof({c}))')} AS data_type, "
    f"count({c}) AS non_null_rows FROM risk_rows" for i, c in enumerate(_RISK_COLUMNS))


def describe_features(spark, sf):
    return pf.describe_features(_rr(spark, sf), [*FEATS, "label"], decimals=6)


SQL_DESCRIBE = RISK + " " + " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, round(CAST(min({c}) AS DOUBLE), 6) AS min_value, "
    f"round(CAST(max({c}) AS DOUBLE), 6) AS max_value FROM risk_rows" for i, c in enumerate([*FEATS, "label"]))


def label_distribution(spark, sf):
    return pf.label_distribution(_rr(spark, sf), "label")


SQL_LABEL_DIST = RISK + """
SELECT label, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM risk_rows GROUP BY label"""


def _grown(spark, sf) -> tuple[str, str]:
    """A folder that gets its rows in two deliveries, profiled after each; folder and its states."""
    root = model_dir(spark, sf, "growing")
    if input_state(spark, f"{root}/done") == input_state(spark):  # a repeated call finds both
        # the star join runs once for both
        rows = fx.written_once(spark, f"{root}/joined", lambda: _rr(spark, sf).select(*FEATS, "label", "split_bucket"))
        for part in (F.col("split_bucket") < 50, F.col("split_bucket") >= 50):
            rows.filter(part).select(*FEATS, "label").write.mode("append").option("compression", "zstd").parquet(f"{root}/rows")
            update_profile(spark, f"{root}/rows", [*FEATS, "label"], "label", f"{root}/states")
        drop_scratch(spark, f"{root}/joined")
        spark.range(1).write.mode("overwrite").parquet(f"{root}/done")
    return f"{root}/rows", f"{root}/states"


def profile_incremental(spark, sf):
    return merged_description(current_states(spark, *_grown(spark, sf)), decimals=6)


def labels_incremental(spark, sf):
    return merged_labels(current_states(spark, *_grown(spark, sf)))


SQL_LABELS_INCREMENTAL = RISK + """
SELECT CAST(label AS VARCHAR) AS label, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM risk_rows GROUP BY ALL"""


def dataset_info(spark, sf):
    return pf.dataset_info(hash_split(_rr(spark, sf), bucket_col="split_bucket"), "part", len(FEATS))


SQL_DATASET_INFO = RISK + f"""
SELECT count(*) AS total_rows, CAST({len(FEATS)} AS BIGINT) AS total_features,
       count(*) FILTER (WHERE split_bucket < 80) AS train_rows,
       count(*) FILTER (WHERE split_bucket >= 80) AS test_rows
FROM risk_rows"""


# ----------------------------------------------------------------------------- projections / quality
def select_features(spark, sf):
    return q.select_features(_rr(spark, sf), CAT)


SQL_SELECT_FEATURES = RISK + " SELECT " + ", ".join(FEATS) + " FROM risk_rows"


def format_kpis(spark, sf):
    counts = hash_split(_rr(spark, sf), bucket_col="split_bucket").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(F.col("part") == "train", 1)).alias("train_rows"),
        F.avg("label").alias("positive_rate"))
    return counts.select(
        thousands_text("total_rows").alias("total_rows_text"),
        thousands_text("train_rows").alias("train_rows_text"),
        percent_text("positive_rate").alias("positive_rate_text"),
        percent_text(F.col("train_rows") / F.col("total_rows")).alias("train_share_text"))


SQL_FORMAT_KPIS = RISK + """,
a AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE split_bucket < 80) AS train_rows,
             avg(label) AS positive_rate FROM risk_rows)
SELECT format('{:,}', total_rows) AS total_rows_text, format('{:,}', train_rows) AS train_rows_text,
       printf('%.1f%%', positive_rate * 100) AS positive_rate_text,
       printf('%.1f%%', train_rows / total_rows * 100) AS train_share_text
FROM a"""


def valid_rows(spark, sf):
    return q.valid_rows(_gaps(spark, sf), GAP_COLS).select(KEY, *GAP_COLS)


SQL_VALID_ROWS = GAPS_SQL + """
SELECT row_key, qty, discount_pct, price FROM gaps
WHERE qty IS NOT NULL AND discount_pct IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)"""


def rejected_rows(spark, sf):
    rej = q.rejected_rows(_gaps(spark, sf), [KEY], GAP_COLS)
    return rej.select(KEY, F.array_join("bad_columns", ",").alias("bad_columns"))


SQL_REJECTED_ROWS = GAPS_SQL + """
SELECT row_key, concat_ws(',', CASE WHEN qty IS NULL THEN 'qty' END,
                               CASE WHEN discount_pct IS NULL THEN 'discount_pct' END,
                               CASE WHEN price IS NULL OR isnan(price) THEN 'price' END) AS bad_columns
FROM gaps WHERE qty IS NULL OR discount_pct IS NULL OR price IS NULL OR isnan(price)"""


def _faults(spark, sf) -> DataFrame:
    """risk_rows with planted faults: a value out of each kind of domain (upper and lower bound, codes)."""
    return (_rr(spark, sf).withColumn("qty", F.when(F.col("qty") == 50, 51).otherwise(F.col("qty")))
            .withColumn("price", F.when(F.col("tax_pct") == 0, -F.col("price")).otherwise(F.col("price")))
            .withColumn("is_returned", F.when(F.col("line_no") == 7, 2).otherwise(F.col("is_returned")))
            .withColumn("priority", F.when(F.col("priority") == 5, 9).otherwise(F.col("priority"))))


FAULTS_SQL = RISK + """,
faults AS (
  SELECT * REPLACE (
    CASE WHEN qty = 50 THEN 51 ELSE qty END AS qty,
    CASE WHEN tax_pct = 0 THEN -price ELSE price END AS price,
    CASE WHEN line_no = 7 THEN 2 ELSE is_returned END AS is_returned,
    CASE WHEN priority = 5 THEN 9 ELSE priority END AS priority)
  FROM risk_rows
)"""


def domain_violations(spark, sf):
    return q.domain_summary(_faults(spark, sf), CAT)


def domain_violation_rows(spark, sf):
    return q.domain_violations(_faults(spark, sf), CAT)


def _domain_sql_rule(spec) -> str | None:
    conds = []
    if spec.values is not None:
        conds.append(f"CAST({spec.name} AS DOUBLE) NOT IN ({', '.join(repr(float(v)) for v in spec.values)})")
    if spec.lo is not None:
        conds.append(f"{spec.name} < {spec.lo}")
    if spec.hi is not None:
        conds.append(f"{spec.name} > {spec.hi}")
    return " OR ".join(conds) if conds else None


SQL_DOMAIN_ROWS = FAULTS_SQL + " " + " UNION ALL ".join(
    f"SELECT row_key, '{s.name}' AS feature, CAST({s.name} AS DOUBLE) AS value FROM faults WHERE {_domain_sql_rule(s)}"
    for s in CAT.features if _domain_sql_rule(s))
SQL_DOMAIN = FAULTS_SQL + " " + " UNION ALL ".join(
    f"SELECT '{s.name}' AS feature, count({s.name}) AS n_checked, "
    + (f"count(*) FILTER (WHERE {s.name} IS NOT NULL AND ({_domain_sql_rule(s)}))" if _domain_sql_rule(s)
       else "CAST(0 AS BIGINT)")
    + " AS n_violations FROM faults" for s in CAT.features)


def fill_defaults(spark, sf):
    return q.fill_defaults(_gaps(spark, sf), CAT, ["qty", "discount_pct"]).select(KEY, "qty", "discount_pct")


SQL_FILL_DEFAULTS = GAPS_SQL + f"""
SELECT row_key, coalesce(qty, {int(CAT.spec('qty').default)}) AS qty,
       coalesce(discount_pct, {int(CAT.spec('discount_pct').default)}) AS discount_pct FROM gaps"""


def decode_categories(spark, sf):
    df = q.decode_categories(_rr(spark, sf), CAT, ["is_returned", "priority", "same_nation"])
    return df.select(KEY, "is_returned_label", "priority_label", "same_nation_label")


def _case(col: str, labels) -> str:
    whens = " ".join(f"WHEN {float(code)!r} THEN '{name}'" for code, name in labels)
    return f"CASE CAST({col} AS DOUBLE) {whens} END"


SQL_DECODE = RISK + f"""
SELECT row_key, {_case('is_returned', CAT.spec('is_returned').labels)} AS is_returned_label,
       {_case('priority', CAT.spec('priority').labels)} AS priority_label,
       {_case('same_nation', CAT.spec('same_nation').labels)} AS same_nation_label
FROM risk_rows"""


# ----------------------------------------------------------------------------- features / split
def assembled_features(spark, sf):
    asm = assembler(FEATS)
    return vector_columns(asm.transform(_rr(spark, sf)), "features", FEATS, keep=[KEY])


SQL_ASSEMBLED = RISK + " SELECT row_key, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS) + " FROM risk_rows"


def _scaler_on_train(rows):
    """Assembler + scaler fitted on the training part (one pass)."""
    asm = assembler(FEATS)
    return asm, fit_scaler(asm.transform(_train(rows)))


def scaler_stats_q(spark, sf):
    _, model = _scaler_on_train(_rr(spark, sf))
    stats = scaler_stats(spark, model, FEATS)
    return stats.select("ordinal", "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


SQL_SCALER_STATS = RISK + ", tr AS (SELECT * FROM risk_rows WHERE split_bucket < 80) " + " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM tr"
    for i, c in enumerate(FEATS))


def scaled_features(spark, sf):
    """Fitted on the training part and applied to every row: the star join runs once, into a copy that both read."""
    rows = fx.risk_rows_table(spark, sf)
    asm, model = _scaler_on_train(rows)
    out = model.transform(asm.transform(rows))
    return vector_columns(out, "scaled_features", FEATS, keep=[KEY], decimals=6)


# "+ 0.0" folds DuckDB's -0.0 (from rounding tiny negatives) into 0.0, as Spark's round does.
SQL_SCALED = RISK + ", st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATS) + " FROM risk_rows WHERE split_bucket < 80) " \
    + "SELECT row_key, " + ", ".join(
        f"round(CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END, 6) + 0.0 AS {c}" for c in FEATS) \
    + " FROM risk_rows, st"


def hash_split_q(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey")
    return hash_split(orders, ["o_orderkey"], train_percent=fx.TRAIN_PERCENT).select("o_orderkey", "split_bucket", "part")


_DUCK_ORDER_HASH = "CAST(('0x' || substring(md5('{salt}|' || CAST(o_orderkey AS VARCHAR)), 1, 7)) AS BIGINT)"
SQL_HASH_SPLIT = f"""
SELECT o_orderkey, CAST({_DUCK_ORDER_HASH.format(salt='split')} % 100 AS INTEGER) AS split_bucket,
       CASE WHEN {_DUCK_ORDER_HASH.format(salt='split')} % 100 < 80 THEN 'train' ELSE 'test' END AS part
FROM orders"""


KEYLESS = ["qty", "price", "discount_pct", "tax_pct", "line_no", "order_total", "cust_balance", "ship_lag_days"]


def hash_split_keyless(spark, sf):
    """The split of a table without a key: by the values of its rows."""
    return hash_split(_rr(spark, sf).select(*KEYLESS), value_cols=KEYLESS, train_percent=fx.TRAIN_PERCENT)


_KEYLESS_HASH = "CAST(('0x' || substring(md5(concat_ws('|', 'split', " + ", ".join(
    f"coalesce(CAST(CAST(trunc({c}) AS BIGINT) AS VARCHAR), '~')" for c in KEYLESS) + ")), 1, 7)) AS BIGINT) % 100"
SQL_HASH_SPLIT_KEYLESS = RISK + f"""
SELECT {', '.join(KEYLESS)}, CAST({_KEYLESS_HASH} AS INTEGER) AS split_bucket,
       CASE WHEN {_KEYLESS_HASH} < 80 THEN 'train' ELSE 'test' END AS part
FROM risk_rows"""


def fold_assignment_q(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return (fold_assignment(orders, ["o_orderkey"], fx.NUM_FOLDS).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total_price")))


SQL_FOLDS = f"""
SELECT CAST({_DUCK_ORDER_HASH.format(salt='fold')} % {fx.NUM_FOLDS} AS INTEGER) AS fold, count(*) AS rows,
       round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY 1"""


# ----------------------------------------------------------------------------- models (closed forms)
# Every fit below is the library's own training job (split, validation, scaler, layout, fit, evaluation, selection,
# saving) on 0/1 features, at settings whose result SQL can state.
def fit_logistic(spark, sf):
    """Logistic regression on one feature, its coefficients back on the feature's own scale."""
    run = closed_run(spark, sf, ("is_returned",))
    model, scale = run.fitted["Logistic Regression"], run.pipeline.stages[1]
    slope = float(model.coefficients[0]) / float(scale.std[0])
    row = [(float(model.intercept) - slope * float(scale.mean[0]), slope)]
    return local_frame(spark, row, "intercept double, coefficient double").select(
        F.round("intercept", 4).alias("intercept"), F.round("coefficient", 4).alias("coefficient"))


SQL_FIT_LOGISTIC = RISK + """,
r AS (SELECT avg(label) FILTER (WHERE is_returned = 0) AS r0, avg(label) FILTER (WHERE is_returned = 1) AS r1
      FROM risk_rows WHERE split_bucket < 80)
SELECT round(ln(r0 / (1 - r0)), 4) AS intercept, round(ln(r1 / (1 - r1)) - ln(r0 / (1 - r0)), 4) AS coefficient
FROM r"""


def _closed_pipeline(spark, sf, model):
    """Assembler, scaler and one of the family's models of the one-feature run."""
    run = closed_run(spark, sf, ONE)
    return pipeline_model([*run.pipeline.stages[:2], run.fitted[model]])


def _tree_probabilities(spark, sf, model) -> DataFrame:
    test = _test(fx.flag_rows_table(spark, sf, ONE))
    scored, _ = score_with_rejects(test, _closed_pipeline(spark, sf, model), closed_catalog(ONE), ["hi_score"])
    return (scored.groupBy("hi_score").agg(F.count(F.lit(1)).alias("rows"),
                                           F.round(F.max("probability"), 6).alias("probability")))


def fit_forest(spark, sf):
    return _tree_probabilities(spark, sf, "Random Forest")


def fit_gbt(spark, sf):
    return _tree_probabilities(spark, sf, "Gradient Boosted Trees")


_SQL_RATES = RISK + f""",
rates AS (SELECT {HI_SCORE_SQL} AS hi_score, avg(label) AS r FROM risk_rows WHERE split_bucket < 80 GROUP BY 1)"""
_SQL_TREE_BASE = _SQL_RATES + f""",
te AS (SELECT {HI_SCORE_SQL} AS hi_score, count(*) AS rows FROM risk_rows WHERE split_bucket >= 80 GROUP BY 1)"""
SQL_FIT_FOREST = _SQL_TREE_BASE + """
SELECT te.hi_score, te.rows, round(r, 6) AS probability FROM te JOIN rates USING (hi_score)"""
SQL_FIT_GBT = _SQL_TREE_BASE + """
SELECT te.hi_score, te.rows, round(1.0 / (1.0 + exp(-2.0 * (2.0 * r - 1.0))), 6) AS probability
FROM te JOIN rates USING (hi_score)"""


def _importances(spark, sf, flags, model) -> DataFrame:
    return ex.feature_importances(spark, closed_run(spark, sf, flags).fitted[model], list(flags)).select("feature", "importance")


def feature_importances_q(spark, sf):
    return _importances(spark, sf, TWO, "Gradient Boosted Trees")


def family_importances(spark, sf):
    """Both tree families: the one split goes to the feature with the largest gain."""
    parts = [_importances(spark, sf, TWO, m).select(F.lit(m).alias("model"), "feature", "importance")
             for m in ("Random Forest", "Gradient Boosted Trees")]
    return parts[0].unionByName(parts[1])


def _sql_gain(flags) -> str:
    """gain(feature, gain): variance gain of a split on each flag over the training part."""
    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({fx.FLAGS[f]} AS INTEGER) AS x, label FROM risk_rows "
                              f"WHERE split_bucket < 80" for f in flags)
    return RISK + f""",
long AS ({rows}),
g AS (SELECT feature, count(*) FILTER (WHERE x = 0) AS n0, count(*) FILTER (WHERE x = 1) AS n1,
             avg(label) FILTER (WHERE x = 0) AS m0, avg(label) FILTER (WHERE x = 1) AS m1 FROM long GROUP BY feature),
gain AS (SELECT feature, n0 * n1 / (n0 + n1) * (m1 - m0) * (m1 - m0) AS gain FROM g),
imp AS (SELECT feature, CAST(CASE WHEN gain = max(gain) OVER () THEN 1.0 ELSE 0.0 END AS DOUBLE) AS importance FROM gain)"""


SQL_IMPORTANCES = _sql_gain(TWO) + " SELECT feature, importance FROM imp"
SQL_FAMILY_IMPORTANCES = _sql_gain(TWO) + """
SELECT model, feature, importance FROM imp, (VALUES ('Random Forest'), ('Gradient Boosted Trees')) AS m(model)"""


def train_family(spark, sf):
    """All scores rise with the feature, so the held-out counts fix every metric, and the first model wins the tie."""
    return closed_run(spark, sf, ONE).leaderboard.select("model", "ordinal", "accuracy", "auc_roc", "f1_score", "positive_f1",
                                                         "recall", "predicted_positive", "test_rows", "is_winner")


def train_weighted(spark, sf):
    """The family on the same rows without their key: equal rows, thousands each, become weights, and nothing else changes."""
    return keyless_run(spark, sf, ONE).leaderboard.select("model", "ordinal", "accuracy", "auc_roc", "f1_score", "positive_f1",
                                                         "recall", "predicted_positive", "test_rows", "is_winner")


def weighted_scaler(spark, sf):
    """Mean and deviation that the keyless run's scaler took from weighted rows."""
    model = keyless_run(spark, sf, ONE).pipeline.stages[1]
    return scaler_stats(spark, model, list(ONE)).select("feature", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


SQL_WEIGHTED_SCALER = RISK + f"""
SELECT 'hi_score' AS feature, round(avg({HI_SCORE_SQL}), 9) AS mean, round(stddev_samp({HI_SCORE_SQL}), 9) AS std
FROM risk_rows WHERE split_bucket < 80"""


def leaderboard_q(spark, sf):
    return auc_percent(closed_run(spark, sf, ONE).leaderboard)


def cross_validate_q(spark, sf):
    """The documented grid of logistic regression over five folds."""
    return _validated(spark, sf, fx.NUM_FOLDS, [LogisticRegression(featuresCol=SCALED, labelCol="label", maxIter=100)])


def cross_validate_trees(spark, sf):
    """The documented grids of both tree families, over five folds."""
    return _validated(spark, sf, fx.NUM_FOLDS, [RandomForestClassifier(featuresCol=SCALED, labelCol="label", seed=42),
                                                GBTClassifier(featuresCol=SCALED, labelCol="label", seed=42)])


def _validated(spark, sf, num_folds, estimators) -> DataFrame:
    rows = _train(fx.flag_rows(spark, sf, ONE))
    found = cross_validate([(e, reference_grids(e)) for e in estimators], assembler(ONE).transform(rows), "label",
                           num_folds=num_folds, row_cols=["row_key"])
    rows = [(r["estimator"], r["point"], round(r["mean_auc"], 9)) for r in found]
    return local_frame(spark, rows, "estimator string, point int, mean_auc double")


def _sql_cv(num_folds, estimators) -> str:
    return RISK + f""",
f AS (SELECT fold, 0.5 * (1 + avg({HI_SCORE_SQL}) FILTER (WHERE label = 1) - avg({HI_SCORE_SQL}) FILTER (WHERE label = 0)) AS auc
      FROM risk_rows WHERE split_bucket < 80 AND fold < {num_folds} GROUP BY fold)
SELECT estimator, CAST(point AS INTEGER) AS point, round(avg(auc), 9) AS mean_auc
FROM f, (VALUES {", ".join(f"('{e}')" for e in estimators)}) AS e(estimator), range(4) AS p(point) GROUP BY ALL"""


SQL_CROSS_VALIDATE = _sql_cv(fx.NUM_FOLDS, ["LogisticRegression"])
SQL_CROSS_VALIDATE_TREES = _sql_cv(fx.NUM_FOLDS, ["RandomForestClassifier", "GBTClassifier"])


# ----------------------------------------------------------------------------- scoring
def _records(spark, sf) -> DataFrame:
    """All rows as records to score, with gaps: no feature where the quantity is 50."""
    rows = fx.flag_rows_table(spark, sf, ONE)
    return rows.select(KEY, "label", F.when(F.col("quantity") != 50, F.col("hi_score")).alias("hi_score"))


def score_batch(spark, sf):
    """Every record, by the saved and reloaded winner (logistic regression: the group's rate)."""
    closed_run(spark, sf, ONE)
    scored, _ = score_job(spark, _records(spark, sf), f"{model_dir(spark, sf, '1-hi_score')}/best_model", closed_catalog(ONE))
    return scored.select(KEY, "prediction", F.round("probability", 6).alias("probability"))


def score_batch_rejects(spark, sf):
    closed_run(spark, sf, ONE)
    _, rejects = score_job(spark, _records(spark, sf), f"{model_dir(spark, sf, '1-hi_score')}/best_model", closed_catalog(ONE))
    return rejects.select(KEY, F.array_join("bad_columns", ",").alias("bad_columns"))


def _status(scored: DataFrame) -> DataFrame:
    return scored.select(KEY, "status", "prediction", F.round("probability", 6).alias("probability"),
                         F.array_join("bad_columns", ",").alias("bad_columns"))


def score_one_pass(spark, sf):
    """Every record, scored or rejected, from one read: the table that the batch job writes."""
    closed_run(spark, sf, ONE)
    out = model_dir(spark, sf, "one-pass")
    score_to(spark, _records(spark, sf), f"{model_dir(spark, sf, '1-hi_score')}/best_model", closed_catalog(ONE), out)
    return _status(spark.read.parquet(out))


def score_trees_q(spark, sf):
    """Both tree families, scored from the files of the saved pipelines."""
    parts = []
    for name in ("Random Forest", "Gradient Boosted Trees"):
        saved = registry.save_pipeline(_closed_pipeline(spark, sf, name), f"{model_dir(spark, sf, 'trees')}/{name.replace(' ', '-')}")
        scored = score_trees(_records(spark, sf), read_trees(spark, saved), [KEY])
        parts.append(scored.select(F.lit(name).alias("model"), KEY, "prediction", F.round("probability", 6).alias("probability")))
    return parts[0].unionByName(parts[1])


def tree_nodes(spark, sf):
    """The saved forest as a table of nodes: one split, two leaves whose shares are the groups' rates."""
    saved = registry.save_pipeline(_closed_pipeline(spark, sf, "Random Forest"), model_dir(spark, sf, "nodes"))
    nodes = read_trees(spark, saved).nodes
    return nodes.select("tree", "node", F.col("left").isNull().alias("is_leaf"), "feature",
                        F.round(F.when(F.col("left").isNull(), F.col("share")), 6).alias("share"), "weight")


SQL_TREE_NODES = _SQL_RATES + """
SELECT 0 AS tree, 0 AS node, false AS is_leaf, 0 AS feature, CAST(NULL AS DOUBLE) AS share, CAST(1 AS DOUBLE) AS weight
UNION ALL SELECT 0, 1 + hi_score, true, NULL, round(r, 6), 1 FROM rates"""
SQL_SCORE_TREES = _SQL_RATES + f"""
SELECT 'Random Forest' AS model, row_key, CAST(r > 0.5 AS INTEGER) AS prediction, round(r, 6) AS probability
FROM risk_rows JOIN rates ON rates.hi_score = {HI_SCORE_SQL} WHERE qty <> 50
UNION ALL
SELECT 'Gradient Boosted Trees', row_key, CAST(r > 0.5 AS INTEGER), round(1.0 / (1.0 + exp(-2.0 * (2.0 * r - 1.0))), 6)
FROM risk_rows JOIN rates ON rates.hi_score = {HI_SCORE_SQL} WHERE qty <> 50"""
_SQL_STATUS = _SQL_RATES + f"""
SELECT row_key, CASE WHEN qty = 50 THEN 'rejected' ELSE 'scored' END AS status,
       CASE WHEN qty <> 50 THEN CAST(r > 0.5 AS INTEGER) END AS prediction,
       CASE WHEN qty <> 50 THEN round({{p}}, 6) END AS probability,
       CASE WHEN qty = 50 THEN 'hi_score' ELSE '' END AS bad_columns
FROM risk_rows JOIN rates ON rates.hi_score = {HI_SCORE_SQL}"""
SQL_SCORE_ONE_PASS = _SQL_STATUS.format(p="r")
SQL_SCORE_STREAM_ONCE = _SQL_STATUS.format(p="1.0 / (1.0 + exp(-2.0 * (2.0 * r - 1.0)))")

SQL_SCORE_BATCH = _SQL_RATES + f"""
SELECT row_key, CAST(r > 0.5 AS INTEGER) AS prediction, round(r, 6) AS probability
FROM risk_rows JOIN rates ON rates.hi_score = {HI_SCORE_SQL} WHERE qty <> 50"""
SQL_REJECTS = RISK + " SELECT row_key, 'hi_score' AS bad_columns FROM risk_rows WHERE qty = 50"


def score_linear(spark, sf):
    df = _rr(spark, sf)
    return df.select(KEY, F.round(linear_probability(LINEAR_COEFS, LINEAR_INTERCEPT), 9).alias("probability"))


_SQL_LINEAR_P = ("1.0 / (1.0 + exp(-(" + repr(LINEAR_INTERCEPT) + " + " + " + ".join(
    f"{w!r} * CAST({c} AS DOUBLE)" for c, w in LINEAR_COEFS.items()) + ")))")
SQL_SCORE_LINEAR = RISK + f" SELECT row_key, round({_SQL_LINEAR_P}, 9) AS probability FROM risk_rows"


def verdicts_q(spark, sf):
    df = _rr(spark, sf).select(KEY, linear_probability(LINEAR_COEFS, LINEAR_INTERCEPT).alias("p"))
    return verdicts(df, "p").select(KEY, "prediction", "verdict")


SQL_VERDICTS = RISK + f"""
SELECT row_key, CAST({_SQL_LINEAR_P} > 0.5 AS INTEGER) AS prediction,
       CASE WHEN {_SQL_LINEAR_P} > 0.5 THEN 'at_risk' ELSE 'no_significant_risk' END AS verdict
FROM risk_rows"""


def _streamed(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All records land as files in the shared folder and are scored by the streaming job with a saved pipeline.

    A repeated call finds source and checkpoint and resumes: nothing is scored twice.
    """
    root = model_dir(spark, sf, "stream")
    saved = registry.save_pipeline(_closed_pipeline(spark, sf, "Gradient Boosted Trees"), f"{root}/model")
    if input_state(spark, f"{root}/source") == input_state(spark):
        _records(spark, sf).drop("label").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/source")
    return run_to_completion(spark, f"{root}/source", registry.load_pipeline(saved, closed_catalog(ONE)), closed_catalog(ONE),
                             f"{root}/sink", f"{root}/checkpoint")


def score_stream(spark, sf):
    """Every record that can be scored (boosted trees: the logistic of the group's one step)."""
    return _streamed(spark, sf)[0].select(KEY, "prediction", F.round("probability", 6).alias("probability"))


def score_stream_rejects(spark, sf):
    """Every record that can't, with the columns that are missing."""
    return _streamed(spark, sf)[1].select(KEY, F.array_join("bad_columns", ",").alias("bad_columns"))


def score_stream_once_q(spark, sf):
    """Every record through the stream that reads each batch once; a repeated call finds its checkpoint and resumes."""
    root = model_dir(spark, sf, "stream-once")
    saved = registry.save_pipeline(_closed_pipeline(spark, sf, "Gradient Boosted Trees"), f"{root}/model")
    if input_state(spark, f"{root}/source") == input_state(spark):
        _records(spark, sf).drop("label").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/source")
    score_stream_once(spark, f"{root}/source", registry.load_pipeline(saved, closed_catalog(ONE)), closed_catalog(ONE),
                      f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return _status(read_sink(spark, f"{root}/sink"))


SQL_SCORE_STREAM = _SQL_RATES + f"""
SELECT row_key, CAST(r > 0.5 AS INTEGER) AS prediction, round(1.0 / (1.0 + exp(-2.0 * (2.0 * r - 1.0))), 6) AS probability
FROM risk_rows JOIN rates ON rates.hi_score = {HI_SCORE_SQL} WHERE qty <> 50"""


# ----------------------------------------------------------------------------- evaluation
def _eval_frame(spark, sf) -> DataFrame:
    return _test(_rr(spark, sf)).select(KEY, "label", eval_score().alias("score"),
                                         (eval_score() >= EVAL_CUT).cast("int").alias("prediction"))


_SQL_EVAL = RISK + f""",
e AS (SELECT row_key, label, {EVAL_SCORE_SQL} AS score, CAST({EVAL_SCORE_SQL} >= {EVAL_CUT} AS INTEGER) AS prediction
      FROM risk_rows WHERE split_bucket >= 80)"""


def confusion_matrix(spark, sf):
    return ev.confusion_counts(_eval_frame(spark, sf), "label", "prediction")


SQL_CONFUSION = _SQL_EVAL + " SELECT label, prediction, count(*) AS rows FROM e GROUP BY label, prediction"


def _metrics(spark, sf):
    return ev.metrics_from_confusion(ev.confusion_counts(_eval_frame(spark, sf), "label", "prediction"))


def accuracy(spark, sf):
    return _metrics(spark, sf).select("n", F.round("accuracy", 9).alias("accuracy"))


def weighted_f1(spark, sf):
    m = _metrics(spark, sf)
    return m.select(F.round("weighted_f1", 9).alias("weighted_f1"), F.round("positive_f1", 9).alias("positive_f1"),
                    F.round("recall", 9).alias("recall"), "predicted_positive")


_SQL_CONF_AGG = _SQL_EVAL + """,
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
             count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp1,
             count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp0,
             count(*) FILTER (WHERE label = 1) AS sup1, count(*) FILTER (WHERE label = 0) AS sup0,
             count(*) FILTER (WHERE prediction = 1) AS pp1, count(*) FILTER (WHERE prediction = 0) AS pp0 FROM e)"""
SQL_ACCURACY = _SQL_CONF_AGG + " SELECT n, round(correct / n, 9) AS accuracy FROM c"
SQL_WEIGHTED_F1 = _SQL_CONF_AGG + """
SELECT round((sup0 * (2.0 * tp0 / (sup0 + pp0)) + sup1 * (2.0 * tp1 / (sup1 + pp1))) / n, 9) AS weighted_f1,
       round(2.0 * tp1 / (sup1 + pp1), 9) AS positive_f1, round(tp1 / sup1, 9) AS recall,
       pp1 AS predicted_positive
FROM c"""


def auc_exact(spark, sf):
    out = ev.auc_exact(_eval_frame(spark, sf), "score", "label")
    return out.select(F.round("auc", 9).alias("auc"), "n_pos", "n_neg")


def _sql_auc(source: str, group: str | None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
g AS (SELECT {g}score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS n
      FROM {source} GROUP BY ALL),
b AS (SELECT *, coalesce(sum(n) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM g),
auc AS (SELECT {g}sum(p * (nb + n / 2.0)) / (sum(p) * sum(n)) AS auc, sum(p) AS n_pos, sum(n) AS n_neg
        FROM b GROUP BY ALL)"""


SQL_AUC = _SQL_EVAL + "," + _sql_auc("e", None) + """
SELECT round(auc, 9) AS auc, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM auc"""


BINS = 1000  # the bins of the reference's evaluator


def _binned(spark, sf) -> DataFrame:
    return ev.roc_binned(_test(_rr(spark, sf)).select("label", "price"), "price", "label", BINS)


def roc_binned(spark, sf):
    """The binned ROC curve of a score with many distinct values (the price)."""
    return _binned(spark, sf).select("point", "threshold", "tp", "fp", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


def auc_binned(spark, sf):
    return ev.auc_binned(_binned(spark, sf)).select(F.round("auc", 9).alias("auc"), "n_points")


_SQL_BINNED = RISK + f""",
c AS (SELECT price AS score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
      FROM risk_rows WHERE split_bucket >= 80 GROUP BY price),
k AS (SELECT *, (row_number() OVER (ORDER BY score DESC) - 1) // greatest(1, (SELECT count(*) FROM c) // {BINS}) + 1 AS point FROM c),
b AS (SELECT point, min(score) AS threshold, sum(p) AS p, sum(n) AS n FROM k GROUP BY point
      UNION ALL SELECT 0, NULL, 0, 0),
roc AS (SELECT point, threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
               sum(p) OVER w / sum(p) OVER () AS tpr, sum(n) OVER w / sum(n) OVER () AS fpr
        FROM b WINDOW w AS (ORDER BY point ROWS UNBOUNDED PRECEDING))"""
SQL_ROC_BINNED = _SQL_BINNED + " SELECT point, threshold, tp, fp, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr FROM roc"
SQL_AUC_BINNED = _SQL_BINNED + """
SELECT round(sum((fpr - before_fpr) * (tpr + before_tpr) / 2), 9) AS auc, max(point) AS n_points
FROM (SELECT *, lag(fpr) OVER (ORDER BY point) AS before_fpr, lag(tpr) OVER (ORDER BY point) AS before_tpr FROM roc)"""


# Three fixed scorers over the same rows: (name, ordinal, score, decision cut).
SCORERS = [("qty_discount", 1, eval_score, EVAL_SCORE_SQL, EVAL_CUT),
           ("qty_only", 2, lambda: F.col("qty"), "qty", 45),
           ("price_only", 3, lambda: F.col("price"), "price", 80000)]


def _scored_long(spark, sf) -> DataFrame:
    df = _test(_rr(spark, sf))
    items = [F.struct(F.lit(n).alias("model"), F.lit(o).alias("ordinal"), s().cast("double").alias("score"),
                      (s() >= cut).cast("int").alias("prediction")) for n, o, s, _, cut in SCORERS]
    return df.select("label", F.explode(F.array(*items)).alias("m")).select("label", "m.*")


def leaderboard_from_scores(spark, sf):
    board = ev.evaluate_groups(_scored_long(spark, sf), "label", "score", "prediction", ["model", "ordinal"])
    return board.select("model", "ordinal", F.round("accuracy", 9).alias("accuracy"), F.round("auc", 9).alias("auc_roc"),
                        F.round("weighted_f1", 9).alias("f1_score"))


_SQL_LONG = RISK + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS model, {o} AS ordinal, label, CAST({s} AS DOUBLE) AS score, "
    f"CAST({s} >= {cut} AS INTEGER) AS prediction FROM risk_rows WHERE split_bucket >= 80"
    for n, o, _, s, cut in SCORERS) + ")"
_SQL_BOARD = _SQL_LONG + "," + _sql_auc("long", "model") + """,
c AS (SELECT model, ordinal, count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
             count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp1,
             count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp0,
             count(*) FILTER (WHERE label = 1) AS sup1, count(*) FILTER (WHERE label = 0) AS sup0,
             count(*) FILTER (WHERE prediction = 1) AS pp1, count(*) FILTER (WHERE prediction = 0) AS pp0
      FROM long GROUP BY model, ordinal),
board AS (
  SELECT c.model, c.ordinal, round(correct / n, 9) AS accuracy, round(auc.auc, 9) AS auc_roc,
         round((sup0 * CASE WHEN sup0 + pp0 > 0 THEN 2.0 * tp0 / (sup0 + pp0) ELSE 0 END
              + sup1 * CASE WHEN sup1 + pp1 > 0 THEN 2.0 * tp1 / (sup1 + pp1) ELSE 0 END) / n, 9) AS f1_score
  FROM c JOIN auc USING (model))"""
SQL_LEADERBOARD_FROM_SCORES = _SQL_BOARD + " SELECT * FROM board"


def select_winner_q(spark, sf):
    return select_winner(leaderboard_from_scores(spark, sf)).select("model", "ordinal", "auc_roc")


SQL_SELECT_WINNER = _SQL_BOARD + """
SELECT model, ordinal, auc_roc FROM board ORDER BY round(auc_roc, 4) DESC, ordinal ASC LIMIT 1"""


# ----------------------------------------------------------------------------- explanation
def _ranked(spark, sf, k, **options) -> DataFrame:
    return ex.top_k(_importances(spark, sf, ALL, "Gradient Boosted Trees"), "importance", k, **options).select(
        "rank", "feature", "importance")


def top_k_importances(spark, sf):
    return _ranked(spark, sf, 10)


def top_five_importances(spark, sf):
    return _ranked(spark, sf, 5)


def importance_chart(spark, sf):
    """12 largest, listed ascending (chart order)."""
    return _ranked(spark, sf, 12, ascending_output=True)


SQL_TOP_K = _sql_gain(ALL) + """
SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature ASC) AS INTEGER) AS rank, feature, importance
FROM imp ORDER BY importance DESC, feature ASC LIMIT 10"""
SQL_TOP_FIVE = SQL_TOP_K.replace("LIMIT 10", "LIMIT 5")
SQL_IMPORTANCE_CHART = SQL_TOP_K.replace("LIMIT 10", "LIMIT 12")


def risk_profile(spark, sf):
    return ex.risk_profile(_rr(spark, sf), [KEY], ex.fixture_risk_factors())


SQL_RISK_PROFILE = RISK + """,
t AS (SELECT * FROM risk_rows)
SELECT row_key, factor, round(value, 6) AS value FROM (
  SELECT row_key, 'qty' AS factor, least(qty / 50.0, 1.0) AS value FROM t
  UNION ALL SELECT row_key, 'discount', discount_pct / 10.0 FROM t
  UNION ALL SELECT row_key, 'returned', CAST(is_returned AS DOUBLE) FROM t
  UNION ALL SELECT row_key, 'priority', (priority - 1) / 4.0 FROM t
  UNION ALL SELECT row_key, 'ship_month', (ship_month - 1) / 11.0 FROM t
  UNION ALL SELECT row_key, 'open_order', CAST(order_open AS DOUBLE) FROM t
  UNION ALL SELECT row_key, 'unfinished', 1.0 - is_finished FROM t
  UNION ALL SELECT row_key, 'same_nation', CAST(same_nation AS DOUBLE) FROM t)"""


def risk_bands(spark, sf):
    df = _rr(spark, sf).select(linear_probability(LINEAR_COEFS, LINEAR_INTERCEPT).alias("p"))
    return ex.band_counts(df, "p")


SQL_RISK_BANDS = RISK + f"""
SELECT CASE WHEN p * 100 < 33 THEN 'low' WHEN p * 100 < 66 THEN 'medium' ELSE 'high' END AS band, count(*) AS rows
FROM (SELECT {_SQL_LINEAR_P} AS p FROM risk_rows) GROUP BY 1"""


def report_json(spark, sf):
    """The run report written by the training job, read back from the shared folder (times left out)."""
    closed_run(spark, sf, ONE)  # trains (once) and writes the report
    path = f"{model_dir(spark, sf, '1-hi_score')}/metrics"
    doc = registry.read_report(spark, path)
    if doc is None:
        raise FileNotFoundError(path)
    return doc.select("best_model", "best_metrics.accuracy", "best_metrics.auc_roc", "best_metrics.f1_score", "dataset_info.*",
                      F.array_join("feature_columns", ",").alias("feature_columns"),
                      F.size("all_models").alias("n_models"))


_SQL_CLOSED = _SQL_RATES + f""",
e AS (SELECT label, r AS score, CAST(r > 0.5 AS INTEGER) AS prediction FROM risk_rows JOIN rates ON rates.hi_score = {HI_SCORE_SQL}
      WHERE split_bucket >= 80),""" + _sql_auc("e", None) + """,
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
             count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp1, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp0,
             count(*) FILTER (WHERE label = 1) AS sup1, count(*) FILTER (WHERE label = 0) AS sup0,
             count(*) FILTER (WHERE prediction = 1) AS pp1, count(*) FILTER (WHERE prediction = 0) AS pp0 FROM e),
m AS (SELECT round(correct / n, 4) AS accuracy, round(auc, 4) AS auc_roc,
             round((sup0 * (2.0 * tp0 / (sup0 + pp0)) + sup1 * (2.0 * tp1 / (sup1 + pp1))) / n, 4) AS f1_score,
             round(2.0 * tp1 / (sup1 + pp1), 4) AS positive_f1, round(tp1 / sup1, 4) AS recall,
             pp1 AS predicted_positive, n AS test_rows FROM c, auc),
models AS (SELECT * FROM (VALUES ('Logistic Regression', 1), ('Random Forest', 2), ('Gradient Boosted Trees', 3)) AS v(model, ordinal))"""
SQL_TRAIN_FAMILY = _SQL_CLOSED + """
SELECT model, ordinal, accuracy, auc_roc, f1_score, positive_f1, recall, predicted_positive, test_rows, ordinal = 1 AS is_winner
FROM models, m"""
SQL_LEADERBOARD = _SQL_CLOSED + """
SELECT model, round(auc_roc * 100, 1) AS auc_pct, printf('%.1f%%', auc_roc * 100) AS auc_text FROM models, m"""
SQL_REPORT = _SQL_CLOSED + """
SELECT 'Logistic Regression' AS best_model, accuracy, auc_roc, f1_score, (SELECT count(*) FROM risk_rows) AS total_rows,
       CAST(1 AS BIGINT) AS total_features, (SELECT count(*) FROM risk_rows WHERE split_bucket < 80) AS train_rows, test_rows,
       'hi_score' AS feature_columns, 3 AS n_models FROM m"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_training": scan_training,
    "zip_features_target": zip_features_target_q,
    "records_from_json": records_from_json_q,
    "split_counts": split_counts,
    "schema_report": schema_report,
    "describe_features": describe_features,
    "label_distribution": label_distribution,
    "dataset_info": dataset_info,
    "select_features": select_features,
    "format_kpis": format_kpis,
    "valid_rows": valid_rows,
    "rejected_rows": rejected_rows,
    "domain_violations": domain_violations,
    "domain_violation_rows": domain_violation_rows,
    "fill_defaults": fill_defaults,
    "decode_categories": decode_categories,
    "assembled_features": assembled_features,
    "scaler_stats": scaler_stats_q,
    "scaled_features": scaled_features,
    "hash_split": hash_split_q,
    "hash_split_keyless": hash_split_keyless,
    "fold_assignment": fold_assignment_q,
    "fit_logistic": fit_logistic,
    "fit_forest": fit_forest,
    "fit_gbt": fit_gbt,
    "feature_importances": feature_importances_q,
    "train_family": train_family,
    "leaderboard": leaderboard_q,
    "family_importances": family_importances,
    "cross_validate": cross_validate_q,
    "cross_validate_trees": cross_validate_trees,
    "score_batch": score_batch,
    "score_batch_rejects": score_batch_rejects,
    "score_linear": score_linear,
    "verdicts": verdicts_q,
    "score_stream": score_stream,
    "score_stream_rejects": score_stream_rejects,
    "confusion_matrix": confusion_matrix,
    "accuracy": accuracy,
    "weighted_f1": weighted_f1,
    "auc_exact": auc_exact,
    "roc_binned": roc_binned,
    "auc_binned": auc_binned,
    "leaderboard_from_scores": leaderboard_from_scores,
    "select_winner": select_winner_q,
    "top_k_importances": top_k_importances,
    "top_five_importances": top_five_importances,
    "importance_chart": importance_chart,
    "risk_profile": risk_profile,
    "corrupt_records": corrupt_records,
    "profile_incremental": profile_incremental,
    "labels_incremental": labels_incremental,
    "train_weighted": train_weighted,
    "weighted_scaler": weighted_scaler,
    "score_one_pass": score_one_pass,
    "score_trees": score_trees_q,
    "tree_nodes": tree_nodes,
    "score_stream_once": score_stream_once_q,
    "risk_bands": risk_bands,
    "report_json": report_json,
}

ORACLE_SQL: dict[str, str] = {
    "scan_training": SQL_SCAN_TRAINING,
    "zip_features_target": SQL_ZIP,
    "records_from_json": SQL_RECORDS,
    "split_counts": SQL_SPLIT_COUNTS,
    "schema_report": SQL_SCHEMA_REPORT,
    "describe_features": SQL_DESCRIBE,
    "label_distribution": SQL_LABEL_DIST,
    "dataset_info": SQL_DATASET_INFO,
    "select_features": SQL_SELECT_FEATURES,
    "format_kpis": SQL_FORMAT_KPIS,
    "valid_rows": SQL_VALID_ROWS,
    "rejected_rows": SQL_REJECTED_ROWS,
    "domain_violations": SQL_DOMAIN,
    "fill_defaults": SQL_FILL_DEFAULTS,
    "decode_categories": SQL_DECODE,
    "assembled_features": SQL_ASSEMBLED,
    "scaler_stats": SQL_SCALER_STATS,
    "scaled_features": SQL_SCALED,
    "hash_split": SQL_HASH_SPLIT,
    "fold_assignment": SQL_FOLDS,
    "fit_logistic": SQL_FIT_LOGISTIC,
    "fit_forest": SQL_FIT_FOREST,
    "fit_gbt": SQL_FIT_GBT,
    "feature_importances": SQL_IMPORTANCES,
    "domain_violation_rows": SQL_DOMAIN_ROWS,
    "hash_split_keyless": SQL_HASH_SPLIT_KEYLESS,
    "train_family": SQL_TRAIN_FAMILY,
    "leaderboard": SQL_LEADERBOARD,
    "family_importances": SQL_FAMILY_IMPORTANCES,
    "cross_validate": SQL_CROSS_VALIDATE,
    "cross_validate_trees": SQL_CROSS_VALIDATE_TREES,
    "score_batch": SQL_SCORE_BATCH,
    "score_batch_rejects": SQL_REJECTS,
    "score_stream": SQL_SCORE_STREAM,
    "score_stream_rejects": SQL_REJECTS,
    "report_json": SQL_REPORT,
    "top_five_importances": SQL_TOP_FIVE,
    "score_linear": SQL_SCORE_LINEAR,
    "verdicts": SQL_VERDICTS,
    "confusion_matrix": SQL_CONFUSION,
    "accuracy": SQL_ACCURACY,
    "weighted_f1": SQL_WEIGHTED_F1,
    "auc_exact": SQL_AUC,
    "roc_binned": SQL_ROC_BINNED,
    "auc_binned": SQL_AUC_BINNED,
    "leaderboard_from_scores": SQL_LEADERBOARD_FROM_SCORES,
    "select_winner": SQL_SELECT_WINNER,
    "top_k_importances": SQL_TOP_K,
    "importance_chart": SQL_IMPORTANCE_CHART,
    "risk_profile": SQL_RISK_PROFILE,
    "corrupt_records": SQL_CORRUPT,
    "profile_incremental": SQL_DESCRIBE,
    "labels_incremental": SQL_LABELS_INCREMENTAL,
    "train_weighted": SQL_TRAIN_FAMILY,
    "weighted_scaler": SQL_WEIGHTED_SCALER,
    "score_one_pass": SQL_SCORE_ONE_PASS,
    "score_trees": SQL_SCORE_TREES,
    "tree_nodes": SQL_TREE_NODES,
    "score_stream_once": SQL_SCORE_STREAM_ONCE,
    "risk_bands": SQL_RISK_BANDS,
}
