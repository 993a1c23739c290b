"""Classifier queries: ``documents`` with ``labels``.

Metrics are checked on a score derived from the text length, which SQL can
repeat. Fitted models are checked by what must hold whatever the solver does:
the rows of the split, a vanishing gradient, scores that agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.operators import contracts, features, metrics, models, sharded, training
from textgauge.operators.metrics import predict
from textgauge.operators.training import Settings
from textgauge.plans.classifier_run import classifier_run, run_summary
from textgauge.session import materialise, scratch_path
from textgauge.sources.tables import table
from textgauge.workload.registry import documents, labelled, placed, query

SCORE_SQL = (
    "WITH s AS (SELECT d.doc_id, d.text, l.quality AS label, round(d.n_chars / (d.n_chars + 1000.0::DOUBLE), 9) AS score "
    "FROM documents d JOIN labels l USING (doc_id)), p AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM s) "
)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    score = F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0)), 9)
    rows = labelled(spark, sf).select("doc_id", "label", score.alias("score"))
    return rows.withColumn("prediction", predict(F.col("score")))


@query("A18_confusion_matrix", SCORE_SQL + "SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, "
       "count(*) FILTER (prediction = 1) AS predicted_1 FROM p GROUP BY label")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(scored(spark, sf))


@query(
    "A19_classification_report",
    SCORE_SQL + ", c AS (SELECT k, count(*) FILTER (label = k AND prediction = k) AS tp, count(*) FILTER (prediction = k) "
    "AS pp, count(*) FILTER (label = k) AS support FROM p, (VALUES (0), (1)) AS v(k) GROUP BY k), "
    "m AS (SELECT CAST(k AS VARCHAR) AS class, coalesce(tp / nullif(pp, 0), 0) AS precision, "
    "coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2.0 * tp / nullif(pp + support, 0), 0) AS f1, support, tp FROM c) "
    "SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM m "
    "UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM m "
    "UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), "
    "CAST(sum(support) AS BIGINT) FROM m "
    "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), "
    "round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), "
    "CAST(sum(support) AS BIGINT) FROM m",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.classification_report(scored(spark, sf))
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(
    "A20_roc_auc",
    SCORE_SQL + ", r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk "
    "FROM s), n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM s) "
    "SELECT p AS positives, q AS negatives, round((SELECT sum(rk) FROM r WHERE label = 1) / (CAST(p AS DOUBLE) * q) "
    "- (p + 1) / 2 / q, 9) AS roc_auc FROM n",
)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_auc(scored(spark, sf)).withColumn("roc_auc", F.round("roc_auc", 9))


CURVE = (
    SCORE_SQL + ", g AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM s "
    "GROUP BY score), c AS (SELECT *, sum(pos) OVER o AS cp, sum(neg) OVER o AS cn, lead(pos) OVER o AS np, "
    "lead(neg) OVER o AS nn, row_number() OVER o AS i, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g "
    "WINDOW o AS (ORDER BY score DESC)) "
    "SELECT 'inf'::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL "
    "SELECT score, round(cn / n, 9), round(cp / p, 9) FROM c "
)


@query("A21_roc_points", CURVE)
def roc_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_curve(scored(spark, sf), thin=False))


@query("A21_roc_corners", CURVE + "WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg")
def roc_corners(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_curve(scored(spark, sf)))


def rounded(curve: DataFrame) -> DataFrame:
    return curve.withColumns({c: F.round(c, 9) for c in ("fpr", "tpr")})


@query("P12_misclassified", SCORE_SQL + "SELECT doc_id, label, prediction, score, round(abs(score - 0.5), 9) AS margin FROM p "
       "WHERE prediction <> label")
def misclassified(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.misclassified(scored(spark, sf)).withColumn("margin", F.round("margin", 9))


@query("W9_hardest_errors", SCORE_SQL + "SELECT *, row_number() OVER (ORDER BY abs(score - 0.5), doc_id) AS place FROM ("
       "SELECT doc_id, label, prediction, score FROM p WHERE prediction <> label "
       "ORDER BY abs(score - 0.5), doc_id LIMIT 10)")
def hardest_errors(spark: SparkSession, sf: str) -> DataFrame:
    wrong = metrics.misclassified(scored(spark, sf))
    return placed(metrics.hardest(wrong, "doc_id")).drop("margin")


@query("A10_label_counts", "SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality")
def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.label_counts(table(spark, sf, "labels"), "quality")


@query("A11_class_distribution", "SELECT toxic AS label, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY toxic")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.label_counts(labelled(spark, sf, "toxic"))


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its label where there is one."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return documents(spark, sf).select("doc_id", "text").join(labels, "doc_id", "left")


@query("P3_usable_rows", "SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id) "
       "WHERE text IS NOT NULL AND quality IS NOT NULL")
def usable_rows(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.usable_rows(gappy(spark, sf)).select("doc_id", "text", "label")


CONTRACTS = (
    "SELECT 'labels_kept' AS dataset, NULL AS violation FROM labels WHERE false "
    f"UNION ALL SELECT 'lines', '{contracts.NOT_BINARY}' FROM (SELECT count(DISTINCT l_linenumber) AS k FROM lineitem) WHERE k <> 2 "
    f"UNION ALL SELECT 'positives', '{contracts.NOT_BINARY}' FROM (SELECT count(*) AS k FROM labels WHERE toxic = 1) WHERE k > 0 "
    f"UNION ALL SELECT 'unlabelled', '{contracts.EMPTY}' FROM (SELECT count(*) AS k FROM documents) WHERE k > 0 "
)


@query("A24_contract_violations", CONTRACTS)
def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """A good table, one with more labels, one with a single label, one without."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("text"), F.col("l_linenumber").alias("label")
    )
    datasets = {
        "labels_kept": labelled(spark, sf),
        "lines": lines,
        "positives": labelled(spark, sf, "toxic").where("label = 1"),
        "unlabelled": documents(spark, sf).select("text", F.lit(None).cast("int").alias("label")),
    }
    found = None
    for name, df in datasets.items():
        broken = contracts.violations(df).select(F.lit(name).alias("dataset"), "violation")
        found = broken if found is None else found.unionByName(broken)
    return found


@query("U4_missing_columns", "SELECT 'label' AS \"column\", count(*) AS \"rows\" FROM documents")
def missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    n = docs.select(F.count(F.lit(1))).scalar()
    return contracts.missing_columns(docs).select("column", n.alias("rows"))


PARTS = """WITH k AS (SELECT doc_id, {y} AS label, row_number() OVER (PARTITION BY {y}
ORDER BY md5(concat_ws(':', '42', doc_id))) AS r, count(*) OVER (PARTITION BY {y}) AS n
FROM documents JOIN labels USING (doc_id)) """


@query("W6_stratified_split", PARTS.format(y="quality") + "SELECT doc_id, label, CASE WHEN r <= ceil(n * 0.2::DOUBLE) "
       "THEN 'test' ELSE 'train' END AS split FROM k")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf)
    cuts = features.fit_split(rows, "doc_id")
    return features.apply_split(rows, cuts, "doc_id").select("doc_id", "label", "split")


@query("W6_three_way_split", PARTS.format(y="toxic") + ", h AS (SELECT *, ceil(n * (0.1::DOUBLE + 0.1::DOUBLE)) AS held FROM k) "
       "SELECT doc_id, label, CASE WHEN r <= ceil(held * (1 - 0.1::DOUBLE / (0.1::DOUBLE + 0.1::DOUBLE))) THEN 'test' "
       "WHEN r <= held THEN 'val' ELSE 'train' END AS split FROM h")
def three_way_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf, "toxic")
    cuts = features.fit_split(rows, "doc_id", test_size=0.1, val_size=0.1)
    return features.apply_split(rows, cuts, "doc_id").select("doc_id", "label", "split")


@query("W7_stratified_folds", PARTS.format(y="quality") + "SELECT doc_id, label, CAST((r - 1) * 5 // n AS INTEGER) AS fold FROM k")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf)
    cuts = features.fit_folds(rows, "doc_id")
    return features.apply_folds(rows, cuts, "doc_id").select("doc_id", "label", "fold")


TFIDF = r"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS a FROM documents),
g AS (SELECT doc_id, unnest({grams}) AS term FROM t),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL),
voc AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= {min_df} {top}),
w AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS w FROM tf JOIN voc USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""


@query("M1_tfidf", TFIDF.format(grams="a", min_df=1, top=""))
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return features.tfidf(documents(spark, sf), "doc_id").withColumn("weight", F.round("weight", 6))


@query(
    "M1_tfidf_bigrams",
    TFIDF.format(
        grams="list_concat(a, list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1]))", min_df=3,
        top="ORDER BY sum(tf) DESC, term LIMIT 2000",
    ),
)
def tfidf_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    weights = features.tfidf(documents(spark, sf), "doc_id", n_max=2, min_df=3, max_features=2000)
    return weights.withColumn("weight", F.round("weight", 6))


@query("M3_class_weights", "SELECT toxic AS label, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 9) AS weight "
       "FROM labels GROUP BY toxic")
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = features.balanced_class_weights(table(spark, sf, "labels"), "toxic")
    return weights.withColumn("weight", F.round("weight", 9))


BALANCED = Settings(class_weight="balanced")
L1 = Settings(penalty="l1", C=5.0)

SPLIT_SQL = PARTS.format(y="toxic") + ", p AS (SELECT *, r <= ceil(n * {share}::DOUBLE) AS tested FROM k) "


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled texts, written once: fitting reads them many times."""
    return materialise(labelled(spark, sf, "toxic").select("doc_id", "text", "label"), "training")


def consistent(rows: DataFrame) -> DataFrame:
    """Whether a prediction is what its score says, and the score a probability."""
    score = F.col("score")
    right = score.between(0, 1) & (F.col("prediction") == (score >= 0.5).cast("int"))
    return rows.withColumn("consistent", F.coalesce(right, F.lit(False)))


@query(
    "M2_logistic_regression",
    SPLIT_SQL.format(share=0.3) + "SELECT CAST(label AS VARCHAR) AS class, count(*) AS support FROM p WHERE tested GROUP BY label "
    "UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), count(*) FROM p WHERE tested",
)
def logistic_regression(spark: SparkSession, sf: str) -> DataFrame:
    """The report on the test part; its values depend on the solver, its classes and counts do not."""
    run = classifier_run(training_rows(spark, sf), "doc_id", BALANCED, test_size=0.3)
    return metrics.classification_report(run.test).select("class", "support")


CONVERGED = SPLIT_SQL.format(share=0.3) + "SELECT true AS converged, count(*) AS train_rows FROM p WHERE NOT tested"


def converged(spark: SparkSession, sf: str, settings: Settings) -> DataFrame:
    """A fit is right when the gradient of its loss is zero, whatever the solver did."""
    run = classifier_run(training_rows(spark, sf), "doc_id", settings, test_size=0.3)
    found = models.loss_gradient(run.model, run.split.where("split = 'train'"), settings)
    return found.select((F.col("gradient") < 1e-6).alias("converged"), F.col("rows").alias("train_rows"))


@query("M2_optimum", CONVERGED)
def optimum(spark: SparkSession, sf: str) -> DataFrame:
    return converged(spark, sf, BALANCED)


@query("M2_l1_optimum", CONVERGED)
def l1_optimum(spark: SparkSession, sf: str) -> DataFrame:
    return converged(spark, sf, L1)


@query("M2_l1_regression", SPLIT_SQL.format(share=0.3) + "SELECT label, count(*) AS tested FROM p WHERE tested GROUP BY label")
def l1_regression(spark: SparkSession, sf: str) -> DataFrame:
    run = classifier_run(training_rows(spark, sf), "doc_id", L1, test_size=0.3)
    return metrics.confusion_matrix(run.test).select("label", (F.col("predicted_0") + F.col("predicted_1")).alias("tested"))


@query(
    "M4_run_summary",
    PARTS.format(y="toxic") + ", h AS (SELECT *, ceil(n * (0.2::DOUBLE + 0.1::DOUBLE)) AS held FROM k), "
    "p AS (SELECT label, CASE WHEN r <= ceil(held * (1 - 0.1::DOUBLE / (0.2::DOUBLE + 0.1::DOUBLE))) THEN 'test' "
    "WHEN r <= held THEN 'val' ELSE 'train' END AS split FROM h) SELECT 'run-1' AS run_id, count(*) AS \"rows\", "
    "'0:' || count(*) FILTER (label = 0) || ',1:' || count(*) FILTER (label = 1) AS classes, "
    "count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, "
    "count(*) FILTER (split = 'test') AS in_matrix, true AS has_auc FROM p",
)
def fitted_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    run = classifier_run(training_rows(spark, sf), "doc_id", BALANCED, test_size=0.2, val_size=0.1)
    one = run_summary(run, "run-1", "2026-01-01T00:00:00Z", f"{sf}/documents.parquet")
    pairs = F.transform(F.map_entries("class_dist"), lambda e: F.concat_ws(":", e.key, e.value.cast("string")))
    matrix = F.aggregate(F.flatten("test.confusion_matrix"), F.lit(0).cast("long"), lambda a, b: a + b)
    return one.select(
        "run_id", "rows", F.array_join(pairs, ",").alias("classes"), "splits.train", "splits.val", "splits.test",
        matrix.alias("in_matrix"), F.col("test.roc_auc").between(0, 1).alias("has_auc"),
    )


@query(
    "M5_grid_search",
    "SELECT CAST(ngram_max AS INTEGER) AS ngram_max, CAST(min_df AS INTEGER) AS min_df, CAST(c AS DOUBLE) AS \"C\", "
    "CAST(row_number() OVER (ORDER BY ngram_max, min_df, c) - 1 AS INTEGER) AS place, true AS has_f1, true AS converged "
    "FROM (VALUES (1), (2)) AS n(ngram_max), (VALUES (1), (2), (3)) AS m(min_df), (VALUES (0.5), (1.0), (2.0)) AS k(c)",
)
def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of the grid in their order, each with a score from all folds.

    Ninety fits, each with all terms; a cell has converged if the gradient of
    each of its five fits vanishes.
    """
    rows = training_rows(spark, sf)
    folded = features.apply_folds(rows, features.fit_folds(rows, "doc_id"), "doc_id")
    found = training.grid_search(folded, settings=BALANCED)
    cells = [(c["ngram_max"], c["min_df"], c["C"], k, 0.0 <= c["f1"] <= 1.0, c["gradient"] < 1e-6) for k, c in enumerate(found.cells)]
    return spark.createDataFrame(cells, "ngram_max int, min_df int, C double, place int, has_f1 boolean, converged boolean")


@query("M6_test_predictions", SPLIT_SQL.format(share=0.3) + "SELECT doc_id, label, true AS consistent FROM p WHERE tested")
def test_predictions(spark: SparkSession, sf: str) -> DataFrame:
    run = classifier_run(training_rows(spark, sf), "doc_id", BALANCED, test_size=0.3)
    return consistent(run.test).select("doc_id", "label", "consistent")


@query("P11_inference", "SELECT doc_id, true AS consistent FROM documents")
def inference(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of all documents, most of which have no label."""
    model = models.fit(training_rows(spark, sf), BALANCED)
    return consistent(models.classify(model, documents(spark, sf).select("doc_id", "text"))).select("doc_id", "consistent")


@query("K5_saved_model", "SELECT doc_id, true AS same FROM documents")
def saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a model that was saved and loaded again, beside its own."""
    path = scratch_path(spark, "model")
    model = models.fit(training_rows(spark, sf), BALANCED)
    models.save_model(model, path)
    own = models.classify(model, documents(spark, sf).select("doc_id", "text")).withColumnRenamed("score", "own")
    both = models.classify(models.load_model(spark, path), own.select("doc_id", "text", "own"))
    return both.select("doc_id", (F.col("score") == F.col("own")).alias("same"))


@query("M4_term_table_scores", "SELECT doc_id, true AS consistent, true AS same FROM documents")
def term_table_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all documents by a model whose terms are a table, beside those of the pipeline."""
    rows, docs = training_rows(spark, sf), documents(spark, sf).select("doc_id", "text")
    by_table = consistent(sharded.classify(sharded.fit(rows, BALANCED), docs)).select("doc_id", "consistent", "score")
    own = models.classify(models.fit(rows, BALANCED), docs).select("doc_id", F.col("score").alias("own"))
    return by_table.join(own, "doc_id").select("doc_id", "consistent", (F.abs(F.col("score") - F.col("own")) < 1e-4).alias("same"))
