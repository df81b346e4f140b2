"""Early stopping, model comparison, best runs, top rows per class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.labels import lookup
from evenkeel.operators.running import with_chunks


def known_number(col: str) -> Column:
    """A metric as a double; one that is no number is unknown."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def early_stopping(
    df: DataFrame,
    run: str,
    epoch: str,
    metric: str,
    patience: int,
    chunk: Column | None = None,
) -> DataFrame:
    """Best epoch of each run, and the epoch at which training would have ended.

    An epoch is better only if it beats both zero and the best one so far. A run
    ends with the first epoch that lies ``patience`` epochs after its best one;
    ``stop_epoch`` is null for a run that never does.

    A run is walked in chunks (see :func:`running_by_chunk`), so a very long one
    is spread over tasks. The rows are shuffled once: the chunk totals are taken
    from the walked chunks.
    """
    # a metric that is no number is no improvement
    known = df.withColumn(metric, known_number(metric))
    work = with_chunks(known, [run], epoch, chunk).select(run, epoch, metric, "_chunk")
    # said here, so that both readers of the walked rows share one shuffle
    work = work.where(F.col(run).isNotNull() & F.col("_chunk").isNotNull())
    inside = Window.partitionBy(run, "_chunk").orderBy(epoch)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    # of equal metrics the earliest place is the greatest struct
    better = F.when(
        F.col(metric) > 0, F.struct(F.col(metric).alias("m"), (-F.col("_at")).alias("neg"), F.col(epoch).alias("e"))
    )
    walked = work.withColumn("_at", F.row_number().over(inside).cast("bigint")).withColumn(
        "_top", F.max(better).over(so_far)
    )

    def placed(top: str) -> Column:
        top = F.col(top)
        return F.when(top.isNotNull(), F.struct(top["m"].alias("m"), (top["neg"] - F.col("_before")).alias("neg"), top["e"].alias("e")))

    earlier = Window.partitionBy(run).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        walked.groupBy(run, "_chunk")
        .agg(F.count("*").alias("_n"), F.max("_top").alias("_chunk_top"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_carried", F.max(placed("_chunk_top")).over(earlier))
        .select(run, "_chunk", "_before", "_carried")
    )
    rows = walked.join(totals, [run, "_chunk"]).select(
        run,
        (F.col("_before") + F.col("_at")).alias("pos"),
        F.col(epoch).alias("epoch"),
        F.greatest("_carried", placed("_top")).alias("best"),
    )
    since = F.col("pos") - F.coalesce(-F.col("best.neg"), F.lit(0))
    row = F.struct("pos", "epoch", "best")
    ends = rows.groupBy(run).agg(F.min(F.when(since >= patience, row)).alias("stop"), F.max(row).alias("last"))
    end = F.coalesce("stop", "last")
    return ends.select(
        run,
        end["best"]["e"].alias("best_epoch"),
        end["best"]["m"].alias("best_metric"),
        F.col("stop.epoch").alias("stop_epoch"),
        end["pos"].alias("epochs_run"),
    )


def compare_models(df: DataFrame, metric: str, model: str = "model") -> DataFrame:
    """Models from best to worst, those without a number last; equal scores by name."""
    return df.orderBy(known_number(metric).desc_nulls_last(), F.col(model).asc())


def best_run(df: DataFrame, variant: str, metric: str, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metric of each variant; ties by ``tie`` ascending, variants without a number drop out.

    An aggregate and not a window, so that the rows of a variant are reduced
    before they are shuffled.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(-known_number(metric), *[F.col(c) for c in tie])
    return (
        df.where(known_number(metric).isNotNull())
        .groupBy(F.col(variant).alias("_variant"))
        .agg(F.min_by(row, order).alias("r"))
        .select("r.*")
    )


def top_n_per_class(
    df: DataFrame,
    label: str,
    score: str,
    n: Mapping[int, int],
    id_col: str,
    rank: str | None = None,
    salts: int = 32,
) -> DataFrame:
    """The ``n[label]`` rows of each class with the highest score, ties by id; scores that are no number come last.

    The literal bound lets Spark drop rows before the shuffle. Each class is
    reduced in ``salts`` parts first, so that the last step of a class that
    holds most rows sees ``salts * n`` rows however many tasks fed it.
    """
    bound = max(n.values())
    name = rank or "_rank"
    order = [known_number(score).desc_nulls_last(), F.col(id_col).asc()]
    parts = df.where(F.col(label).isin(*n)).withColumn("_salt", F.pmod(F.hash(id_col), F.lit(salts)))
    first = Window.partitionBy(label, "_salt").orderBy(*order)
    parts = parts.withColumn(name, F.row_number().over(first)).where(F.col(name) <= bound).drop("_salt", name)
    last = Window.partitionBy(label).orderBy(*order)
    out = (
        parts.withColumn(name, F.row_number().over(last))
        .where(F.col(name) <= bound)
        .where(F.col(name) <= lookup(F.col(label), n))
    )
    return out if rank else out.drop(name)
