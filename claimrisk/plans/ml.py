"""Risk model: labels, inputs, provider-level split, boosted trees, scores."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.columns import flag
from claimrisk.operators import first_order_trees, newton_trees
from claimrisk.operators.lookup_join import lookup_join, null_safe_join
from claimrisk.operators.newton_trees import NewtonModel
from claimrisk.operators.ordered import add_percent_rank, add_rank_among, order_index
from claimrisk.operators.scoring_metrics import auc_roc, average_precision, classification_report
from claimrisk.schemas import FEATURE_SETS, MODEL_FEATURES, PROVIDER_KEYS
from claimrisk.session import file_system, materialise, scratch_dir

LABEL_Z = 3.0
SPLIT_BUCKETS = 10


def features_table(mart: DataFrame, labelled_claims: DataFrame | None = None, carry=()) -> DataFrame:
    """Provider keys, the nine inputs with NULL as 0, and ``fraud_flag``; ``carry`` names more mart columns.

    The label is the peak z-score threshold; with ``labelled_claims`` it is 1 when any claim of the
    provider row is flagged.
    """
    if labelled_claims is None:
        rows, label = mart, flag(F.col("max_zscore") >= LABEL_Z)
    else:
        flags = labelled_claims.groupBy(*PROVIDER_KEYS).agg(F.max("fraud_flag").alias("any_flag"))
        rows = null_safe_join(mart, flags, PROVIDER_KEYS, "left")
        label = F.coalesce("any_flag", F.lit(0))
    return rows.select(
        *PROVIDER_KEYS, *MODEL_FEATURES, label.alias("fraud_flag"), *carry).fillna(0, subset=MODEL_FEATURES)


def features_wide(mart: DataFrame, claims: DataFrame) -> DataFrame:
    """The model inputs plus rank percentile, facility majority and procedures per provider."""
    ranked = add_percent_rank(mart, ["specialty"], "max_zscore", "specialty_rank_percentile")
    procedures = claims.groupBy("provider_id").agg(
        F.count_distinct("procedure_code").alias("unique_hcpcs_per_npi"))
    return _wide(lookup_join(ranked, procedures, ["provider_id"]))


def _wide(rows: DataFrame) -> DataFrame:
    return rows.select(
        *PROVIDER_KEYS, *MODEL_FEATURES, "specialty_rank_percentile",
        flag(F.col("facility_rate") >= 0.5).alias("facility_flag"), "unique_hcpcs_per_npi",
        flag(F.col("max_zscore") >= LABEL_Z).alias("fraud_flag"),
    ).fillna(0, subset=[*MODEL_FEATURES, "unique_hcpcs_per_npi"])


def rank_index(mart: DataFrame) -> DataFrame:
    """The order of peak z-scores in each specialty, to be stored with the mart for ``features_wide_of_new``."""
    return order_index(mart, ["specialty"], "max_zscore")


def features_wide_of_new(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``features_wide`` of new provider rows, a batch or a stream, each ranked among the providers of a stored ``rank_index``.

    ``rows`` have the measures of the mart and ``unique_hcpcs_per_npi``; neither mart nor claims are read.
    """
    return _wide(add_rank_among(rows, index, ["specialty"], "max_zscore", "specialty_rank_percentile"))


def class_balance(features: DataFrame) -> DataFrame:
    """Providers, positives, negatives and the weight that balances them; NULL without positives."""
    positive = F.count_if(F.col("fraud_flag") == 1)
    negative = F.count_if(F.col("fraud_flag") == 0)
    return features.agg(
        F.count("*").alias("providers"), positive.alias("positives"), negative.alias("negatives"),
        F.round(F.try_divide(negative, positive), 4).alias("positive_weight"))


def add_split(features: DataFrame, test_buckets=2, salt="42") -> DataFrame:
    """``split`` = test for about a fifth of the providers; all rows of a provider fall on one side.

    A hash of the provider id decides, so the split needs no shuffle and stays the same when rows are
    added.
    """
    digest = F.md5(F.concat_ws("|", F.col("provider_id").cast("string"), F.lit(salt)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SPLIT_BUCKETS
    return features.withColumn("split", F.when(bucket < test_buckets, "test").otherwise("train"))


def _weighted(train: DataFrame) -> DataFrame:
    """The training rows with ``weight``: positives count by the class ratio of these rows."""
    balance = class_balance(train).first()
    if not balance.positives or not balance.negatives:
        raise ValueError("training rows need both classes")
    weight = F.when(F.col("fraud_flag") == 1, balance.negatives / balance.positives).otherwise(1.0)
    return train.withColumn("weight", weight)


def fit(train: DataFrame, feature_set="reference", rounds=300, depth=6, step=0.05, seed=42,
        max_bins=128) -> PipelineModel:
    """Boosted trees on the given rows, positives weighted by the class ratio of these rows.

    Training is MLlib's distributed histogram algorithm; its per-round state is checkpointed. Nodes of rows are not cached: a
    tree of small depth is walked faster than an array per row and level is stored. Rows that fit a task are trained on there, to
    the same kind of model.
    """
    scratch_dir(train.sparkSession)
    inputs = FEATURE_SETS[feature_set]
    rows = _weighted(train).select(*inputs, F.col("fraud_flag").cast("double").alias("label"), "weight")
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth,
        stepSize=step, seed=seed, maxBins=max_bins, checkpointInterval=10, cacheNodeIds=False)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    if rows.count() <= newton_trees.PARTITION_ROWS:
        return PipelineModel([assembler, first_order_trees.fit(rows, inputs, "label", "weight", trees)])
    return Pipeline(stages=[assembler, trees]).fit(rows)


def fit_newton(train: DataFrame, feature_set="reference", rounds=300, depth=6, step=0.05, **settings) -> NewtonModel:
    """Second-order boosted trees on the given rows: gradients and curvatures, shrunk leaves, a side for missing inputs."""
    return newton_trees.fit(
        _weighted(train), FEATURE_SETS[feature_set], "fraud_flag", "weight", rounds, depth, step, **settings)


# Second-order trees are the kind of the reference results; MLlib's first-order trees are kept beside them.
LEARNERS = {"second_order": fit_newton, "first_order": fit}


def save_model(model, path: str) -> None:
    if isinstance(model, NewtonModel):
        newton_trees.save(SparkSession.active(), model, path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str):
    """A model of either learner, told by what its folder holds."""
    spark = SparkSession.active()
    system, place = file_system(spark, f"{path}/stages")
    return PipelineModel.load(path) if system.exists(place) else newton_trees.load(spark, path)


def model_inputs(model) -> list:
    return list(model.inputs) if isinstance(model, NewtonModel) else model.stages[0].getInputCols()


def score(features: DataFrame, model) -> DataFrame:
    """Add ``risk_score`` and ``predicted_fraud``; works on a batch or a stream of feature rows."""
    if isinstance(model, NewtonModel):
        margin = newton_trees.margin_column(features.sparkSession, model)
        scored = features.withColumn("__margin", margin).withColumn("risk_score", 1 / (1 + F.exp(-F.col("__margin"))))
        return scored.select(*features.columns, "risk_score", flag(F.col("risk_score") > 0.5).alias("predicted_fraud"))
    scored = model.transform(features)
    return scored.select(
        *features.columns,
        vector_to_array("probability")[1].alias("risk_score"),
        F.col("prediction").cast("int").alias("predicted_fraud"))


def evaluate(scored: DataFrame, split="test") -> DataFrame:
    """(metric, class, value) of the scored rows on one side of the split: the classification table,
    AUC-ROC and average precision."""
    held = materialise(scored.filter(F.col("split") == split).select(
        "fraud_flag", "predicted_fraud", "risk_score"))
    report = classification_report(held, "fraud_flag", "predicted_fraud")
    long = report.unpivot(
        ["class"], [F.col(c).cast("double").alias(c) for c in ("precision", "recall", "f1_score", "support")],
        "metric", "value").filter("value is not null")
    curves = auc_roc(held, "fraud_flag", "risk_score").unpivot([], ["auc_roc"], "metric", "value").unionByName(
        average_precision(held, "fraud_flag", "risk_score").unpivot([], ["average_precision"], "metric", "value"))
    return long.select("metric", "class", "value").unionByName(
        curves.select("metric", F.lit("all").alias("class"), "value"))


def importance(spark: SparkSession, model) -> DataFrame:
    """Importance per model input, highest first; one row per input."""
    if isinstance(model, NewtonModel):
        rows = list(model.importance().items())
    else:
        assembler, trees = model.stages
        rows = list(zip(assembler.getInputCols(), map(float, trees.featureImportances.toArray())))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
