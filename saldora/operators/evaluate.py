"""Scores to quality figures: everything is an aggregation of (label, prob).

Scores are frames with an integer ``label`` (0/1) and a double ``prob``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import Band, band, key_hash, round_to
from saldora.operators.rank import cut_points, passed_cuts, running_sums
from saldora.operators.relational import best, with_group_values
from saldora.session import local_frame, small

# The threshold grid and the column order of the comparison table.
THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]
COMPARISON_COLUMNS = [
    "model", "roc_auc", "pr_auc", "precision", "recall", "f1", "sensitivity",
    "specificity", "balanced_accuracy",
]
RATE_COLUMNS = ["precision", "recall", "f1", "sensitivity", "specificity", "balanced_accuracy"]


def add_rates(counts: DataFrame) -> DataFrame:
    """Rates from tn, fp, fn, tp.

    Precision, recall and F1 are 0 where undefined, sensitivity and specificity NULL;
    balanced accuracy averages the recalls of the classes that occur.
    """
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    zero = F.lit(0.0)
    sens, spec = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    return counts.withColumns(
        {
            "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
            "recall": F.coalesce(sens, zero),
            "f1": F.coalesce(F.try_divide(tp * 2.0, tp * 2.0 + fp + fn), zero),
            "sensitivity": sens,
            "specificity": spec,
            "balanced_accuracy": F.coalesce((sens + spec) / 2.0, sens, spec),
        }
    )


def confusion(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(threshold, tn, fp, fn, tp); a probability equal to the threshold is positive."""
    said, true = F.col("prob") >= F.lit(threshold), F.col("label") == 1
    return scores.agg(
        F.count_if(~said & ~true).alias("tn"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & true).alias("fn"),
        F.count_if(said & true).alias("tp"),
    ).select(F.lit(float(threshold)).alias("threshold"), "tn", "fp", "fn", "tp")


def threshold_sweep(
    scores: DataFrame, thresholds: Sequence[float] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and rates at every threshold, in one pass over the scores.

    Rows collapse to the number of thresholds they reach (a histogram of at most
    len(thresholds) + 1 bins per key); the sweep is arithmetic on those bins.
    """
    grid = sorted(THRESHOLDS if thresholds is None else thresholds)
    reached = reduce(
        lambda a, b: a + b, [(F.col("prob") >= F.lit(float(t))).cast("int") for t in grid]
    )
    bins = (
        scores.groupBy(*keys, reached.alias("bin"))
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") != 1).alias("neg"),
        )
    )
    steps = F.array(
        *[
            F.struct(F.lit(i + 1).alias("i"), F.lit(float(t)).alias("t"))
            for i, t in enumerate(grid)
        ]
    )
    said = F.col("bin") >= F.col("s.i")

    def total(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))

    counts = (
        bins.select("*", F.explode(steps).alias("s"))
        .groupBy(*keys, F.col("s.t").alias("threshold"))
        .agg(
            total(~said, "neg").alias("tn"),
            total(said, "neg").alias("fp"),
            total(~said, "pos").alias("fn"),
            total(said, "pos").alias("tp"),
        )
    )
    return add_rates(counts)


def at_thresholds(scores: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """The published columns of the sweep at chosen thresholds."""
    return threshold_sweep(scores, thresholds).select(
        "threshold", *RATE_COLUMNS, "tn", "fp", "fn", "tp"
    )


def _ranked(
    scores: DataFrame, keys: Sequence[str], splits: Sequence[float] | None = None
) -> DataFrame:
    return running_sums(
        scores,
        "prob",
        {"pos": F.count_if(F.col("label") == 1), "n": F.count(F.lit(1))},
        keys,
        descending=True,
        splits=splits,
    )


def _ranking_aggs() -> dict[str, Column]:
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    neg = n - pos
    all_pos, all_n = F.max("all_pos").cast("double"), F.max("all_n").cast("double")
    ahead = F.col("before_pos") + pos / 2.0
    ctp, cn = F.col("before_pos") + pos, F.col("before_n") + n
    return {
        "roc_auc": F.try_divide(F.sum(neg * ahead), all_pos * (all_n - all_pos)),
        "pr_auc": F.try_divide(F.sum(pos * ctp / cn), all_pos),
    }


def roc_auc(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    out = _ranked(scores, keys)
    agg = _ranking_aggs()["roc_auc"].alias("roc_auc")
    return out.groupBy(*keys).agg(agg) if keys else out.agg(agg)


def average_precision(
    scores: DataFrame, keys: Sequence[str] = (), splits: Sequence[float] | None = None
) -> DataFrame:
    """Sum over distinct scores, descending, of the recall step times the precision.

    Not the trapezoidal area: tied scores are one step.
    """
    out = _ranked(scores, keys, splits)
    agg = _ranking_aggs()["pr_auc"].alias("pr_auc")
    return out.groupBy(*keys).agg(agg) if keys else out.agg(agg)


def evaluate(scores: DataFrame, threshold: float = 0.5, key: str = "model") -> DataFrame:
    """One row per model: confusion, rates, ROC-AUC and average precision."""
    aggs = _ranking_aggs()
    areas = _ranked(scores, [key]).groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    rates = threshold_sweep(scores, [threshold], [key])
    return with_group_values(rates, areas, [key])


def comparison(evaluated: DataFrame, digits: int = 4) -> DataFrame:
    """The published comparison table: nine columns, rounded."""
    return evaluated.select(
        "model", *[round_to(c, digits).alias(c) for c in COMPARISON_COLUMNS[1:]]
    )


def best_model(evaluated: DataFrame, by: str = "pr_auc") -> DataFrame:
    return best(evaluated, by, "model")


def operating_points(sweep: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Rows of a sweep chosen for a precision/recall trade-off."""
    wanted = [float(t) for t in thresholds]
    return sweep.filter(F.col("threshold").isin(wanted))


def best_f1(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest F1; the lower threshold wins a tie."""
    pick = F.max_by(F.struct(*sweep.columns), F.struct(F.col("f1"), -F.col("threshold")))
    return sweep.agg(pick.alias("__p")).select("__p.*")


def capacity(scores: DataFrame, key: str, sizes: Sequence[int]) -> DataFrame:
    """(contacted, precision, recall) when only the N best-scored rows can be reached.

    Order: probability descending, then key. The N-th row is found by selection, the
    rows are then counted by which cut they precede.
    """
    spark = scores.sparkSession
    sizes = sorted(set(int(n) for n in sizes))
    ordered = scores.select(key, "label", (-F.col("prob")).alias("__by"))
    cuts = cut_points(ordered, "__by", key, lambda counts: {g: sizes for g in counts})
    groups = (
        ordered.withColumn("tile", passed_cuts(cuts, "__by", key))
        .groupBy("tile")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("pos"))
    )
    wanted = local_frame(spark, [(n, i) for i, n in enumerate(sizes)], "asked long, upto int")
    # Tiles and sizes are both a handful of rows.
    reached = F.sum(F.when(F.col("tile") <= F.col("upto"), F.col("n")).otherwise(0))
    hits = F.sum(F.when(F.col("tile") <= F.col("upto"), F.col("pos")).otherwise(0))
    tiles = groups.agg(
        F.collect_list(F.struct("tile", "n", "pos")).alias("__t"), F.sum("pos").alias("__all")
    )
    rows = (
        wanted.withColumn("__s", F.struct("asked", "upto"))
        .agg(F.collect_list("__s").alias("__w"))
        .withColumn("__t", tiles.select("__t").scalar())
        .withColumn("__all", tiles.select("__all").scalar())
        .select("__t", "__all", F.explode("__w").alias("w"))
        .select("__all", "w.asked", "w.upto", F.inline("__t"))
    )
    return (
        rows.groupBy("asked")
        .agg(reached.alias("contacted"), hits.alias("hits"), F.max("__all").alias("__all"))
        .select(
            "asked",
            "contacted",
            "hits",
            F.try_divide(F.col("hits").cast("double"), F.col("contacted")).alias("precision"),
            F.try_divide(F.col("hits").cast("double"), F.col("__all")).alias("recall"),
        )
    )


def scores_by_band(
    scores: DataFrame, col: str, bands: Sequence[Band], default: str
) -> DataFrame:
    """(band, n, avg_prob, observed_rate): predicted against observed by condition."""
    return scores.groupBy(band(col, bands, default).alias("band")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("prob").alias("avg_prob"),
        F.avg(F.col("label").cast("double")).alias("observed_rate"),
    )


def risk_by_segment(scores: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """(segment, n, avg_prob, observed_rate): does predicted risk follow the segments?"""
    return (
        scores.join(segments, key)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("prob").alias("avg_prob"),
            F.avg(F.col("label").cast("double")).alias("observed_rate"),
        )
    )


# Rows a block of the shuffle has in the mean; it bounds a task and never changes a donor.
BLOCK_ROWS = 100_000


def shuffled_donors(
    df: DataFrame, cols: Sequence[str], key: str, seed: int, blocks: int | None = None
) -> DataFrame:
    """Add ``donor``: a struct of ``cols`` taken from a random other row.

    The rows stand in a ring in the order of a key hash, and each takes the values of the next
    one, so every value is used exactly once and no row is its own donor (but a single one).
    Blocks are ranges of the hash; the last row of a block takes from the first of the next
    block that holds any, one row a block. Donors depend on keys and seed only, not on blocks,
    partitions or cluster settings.
    """
    from pyspark.sql import Window

    if blocks is None:
        blocks = max(1, -(-df.count() // BLOCK_ROWS))
    step = -(-(1 << 60) // blocks)  # hashes lie below 2^60
    placed = df.withColumn("__h", key_hash(key, seed=seed)).withColumn("__block", F.expr(f"__h div {step}L"))
    values = F.struct(*cols)
    order = Window.partitionBy("__block").orderBy("__h", key)
    firsts = placed.groupBy("__block").agg(F.min_by(values, F.struct("__h", key)).alias("__first"))
    ring = Window.orderBy("__block")  # one row a block
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = firsts.select("__block", F.coalesce(F.lead("__first").over(ring), F.first("__first").over(whole)).alias("__carry"))
    inner = placed.withColumn("__next", F.lead(values).over(order))
    joined = inner.join(small(carry), "__block")
    return joined.withColumn("donor", F.coalesce("__next", "__carry")).drop("__h", "__block", "__next", "__carry")
