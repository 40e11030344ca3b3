"""Classifier metrics on any scored frame, exact and without gathering the scores."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.operators.ordered import prefix_sums


def _ratio(numerator, denominator):
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def classification_report(df: DataFrame, label: str, prediction: str,
                          names=("Normal", "Fraud")) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted mean.

    An undefined ratio counts as 0.
    """
    positive, predicted = F.col(label) == 1, F.col(prediction) == 1
    cells = df.agg(
        F.count_if(positive & predicted).alias("tp"),
        F.count_if(~positive & predicted).alias("fp"),
        F.count_if(positive & ~predicted).alias("fn"),
        F.count_if(~positive & ~predicted).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def scores(hit, wrong, missed):
        return [_ratio(hit, hit + wrong), _ratio(hit, hit + missed),
                _ratio(2 * hit, 2 * hit + wrong + missed)]

    low, high = scores(tn, fn, fp), scores(tp, fp, fn)
    macro = [(a + b) / 2 for a, b in zip(low, high)]
    weighted = [_ratio(a * (tn + fp) + b * (tp + fn), total) for a, b in zip(low, high)]
    unknown = F.lit(None).cast("double")
    lines = [
        (names[0], low, tn + fp),
        (names[1], high, tp + fn),
        ("accuracy", [unknown, unknown, _ratio(tp + tn, total)], total),
        ("macro avg", macro, total),
        ("weighted avg", weighted, total),
    ]
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
                 f1.alias("f1_score"), support.alias("support"))
        for name, (precision, recall, f1), support in lines])))


def _score_counts(df, label, score):
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    return prefix_sums(counts, [], "score", ["pos", "neg"])


def auc_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Chance that a positive outscores a negative, ties counting half (Mann-Whitney)."""
    won = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return _score_counts(df, label, score).agg(F.try_divide(F.sum(won), pairs).alias("auc_roc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision at each score, weighted by the recall gained there (step sum)."""
    hits = F.col("pos_total") - F.col("pos_before")
    found = hits + F.col("neg_total") - F.col("neg_before")
    gained = F.try_divide("pos", "pos_total")
    return _score_counts(df, label, score).agg(
        F.sum(gained * F.try_divide(hits, found)).alias("average_precision"))
