"""Classification metrics as aggregates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.operators.ranking import running_totals


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    yes, said_yes = F.col(label) == 1, F.col(prediction) == 1
    no, said_no = F.col(label) == 0, F.col(prediction) == 0
    return pred.agg(
        F.count_if(yes & said_yes).alias("tp"),
        F.count_if(no & said_no).alias("tn"),
        F.count_if(no & said_yes).alias("fp"),
        F.count_if(yes & said_no).alias("fn"),
    )


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row tp, tn, fp, fn, precision, recall (4 decimals, 0 when undefined)."""
    c = F.col
    return confusion_counts(pred, label, prediction).withColumns(
        {
            "precision": F.round(_ratio(c("tp"), c("tp") + c("fp")), 4),
            "recall": F.round(_ratio(c("tp"), c("tp") + c("fn")), 4),
        }
    )


def _counted(pred: DataFrame, label: str, prediction: str | None, proba: str) -> DataFrame:
    """One row per distinct probability: positives, negatives and, with ``prediction``, the confusion counts."""
    yes, no = F.col(label) == 1, F.col(label) == 0
    counts = {"_pos": yes, "_neg": no}
    if prediction:
        said_yes, said_no = F.col(prediction) == 1, F.col(prediction) == 0
        counts |= {"tp": yes & said_yes, "tn": no & said_no, "fp": no & said_yes, "fn": yes & said_no}
    return pred.groupBy(F.col(proba).alias("_p")).agg(*[F.count_if(test).alias(name) for name, test in counts.items()])


def _area(known: Column) -> Column:
    """Aggregate: the share of (positive, negative) pairs that the positive wins, over rows of running totals."""
    wins = F.sum(F.when(known, F.col("_neg") * (F.col("before__pos") + F.col("_pos") / 2.0)))
    pairs = F.sum(F.when(known, F.col("_pos"))) * F.sum(F.when(known, F.col("_neg")))
    return F.try_divide(wins, pairs.cast("double"))


def auc(pred: DataFrame, label: str, proba: str) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL when a class is missing.

    Works on counts per distinct probability: every positive scores over the
    negatives ranked below it. Rows without a probability are left out.
    """
    ahead = running_totals(_counted(pred, label, None, proba), "_p", ["_pos"])
    return ahead.agg(_area(F.col("_p").isNotNull()).alias("auc"))


def classification_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", proba: str = "proba"
) -> DataFrame:
    """One row auc, f1, accuracy, weighted precision and weighted recall of a two-class prediction.

    The rows are counted once, per distinct probability; the area leaves out those without one.
    """
    c = F.col
    ahead = running_totals(_counted(pred, label, prediction, proba), "_p", ["_pos"])
    counts = ahead.agg(
        _area(c("_p").isNotNull()).alias("auc"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("tp", "tn", "fp", "fn")]
    )
    pos, neg = c("tp") + c("fn"), c("tn") + c("fp")
    total = pos + neg
    p1, r1 = _ratio(c("tp"), c("tp") + c("fp")), _ratio(c("tp"), pos)
    p0, r0 = _ratio(c("tn"), c("tn") + c("fn")), _ratio(c("tn"), neg)

    def weighted(of_one: Column, of_zero: Column) -> Column:
        return _ratio(pos * of_one + neg * of_zero, total)

    return counts.select(
        "auc",
        weighted(_ratio(2.0 * p1 * r1, p1 + r1), _ratio(2.0 * p0 * r0, p0 + r0)).alias("f1"),
        _ratio(c("tp") + c("tn"), total).alias("accuracy"),
        weighted(p1, p0).alias("weighted_precision"),
        weighted(r1, r0).alias("weighted_recall"),
    )
