"""Training-history operators: early stopping, plateau LR schedule, best checkpoint, and
validation-monitored epoch training re-aimed at Spark ML's warm-startable MLP.

A history table holds one row per (run, epoch).  The stopping and LR rules are sequential
state machines.  Every run is folded block by block: one round folds the epochs of one block
(``BLOCK_EPOCHS`` of them) of all runs in parallel, JVM-side, starting from the states that
the round before left.  A task so holds one block of a run at most, however long the run is,
and runs of any length follow the same rule.  Infinite and NaN losses never improve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelearn.session import cut_lineage

BLOCK_EPOCHS = 100_000
CUT_EVERY = 8


def with_epoch_index(df: DataFrame, run: str, order_cols) -> DataFrame:
    """1-based epoch number per run from an ordering.

    Rows are range-partitioned by (run, order); the partition ids are materialised once, each
    partition counts and ranks its own rows, and the counts of the partitions before shift the
    ranks.  A long run spreads over many partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(df.repartitionByRange(parts, F.col(run), *order_cols).withColumn("_pid", F.spark_partition_id()))
    before = Window.partitionBy("_run").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    n = d.groupBy(F.col(run).alias("_run"), F.col("_pid").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    n = n.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("_pid", run).orderBy(*order_cols))
    return (d.withColumn("_rank", rank).join(n, (F.col("_pid") == F.col("_of")) & F.col(run).eqNullSafe(F.col("_run")))
            .withColumn("epoch", (F.col("_start") + F.col("_rank")).cast("int"))
            .drop("_pid", "_rank", "_run", "_of", "_n", "_start"))


def fold_runs(df: DataFrame, run: str, epoch: str, value: str, init, step, block: int | None = None) -> DataFrame:
    """(run, s): the state of each run after all its epochs in order; ``step(state, x)`` sees x.e, x.v."""
    block = block or BLOCK_EPOCHS
    x = F.struct(F.col(epoch).alias("e"), F.col(value).cast("double").alias("v"))
    h = df.select(F.col(run).alias("_run"), F.floor(F.col(epoch) / F.lit(block)).alias("_blk"), x.alias("x"))
    blocks = sorted(r["_blk"] for r in h.select("_blk").distinct().collect())  # one per BLOCK_EPOCHS epochs
    if len(blocks) > 1:
        h = cut_lineage(h)
    state = None
    for i, b in enumerate(blocks or [0]):
        part = h.where(F.col("_blk") == b).groupBy("_run").agg(F.array_sort(F.collect_list("x")).alias("h"))
        if state is None:
            state = part.select("_run", F.aggregate("h", init, step).alias("s"))
            continue
        both = state.select(F.col("_run").alias("_was"), "s").join(part, F.col("_was").eqNullSafe(F.col("_run")), "full")
        known = F.when(F.col("s").isNotNull(), F.col("s")).otherwise(init)
        new = F.when(F.col("h").isNull(), F.col("s")).otherwise(F.aggregate("h", known, step))
        state = both.select(F.coalesce("_run", "_was").alias("_run"), new.alias("s"))
        if i % CUT_EVERY == 0:
            state = cut_lineage(state)
    return state.select(F.col("_run").alias(run), "s")


def early_stop(df: DataFrame, run: str, epoch: str, loss: str, patience: int = 4, min_delta: float = 1e-5,
               block: int | None = None) -> DataFrame:
    """Improvement means loss < best − min_delta; otherwise the counter grows; stop when it
    reaches ``patience``.  Output (run, stop_epoch or null, best_loss, best_epoch, n_epochs)."""
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("be"), F.lit(0).alias("cnt"),
                    F.lit(None).cast("int").alias("stop"), F.lit(0).alias("n"))

    def step(s, x):
        improved = x["v"] < s["best"] - F.lit(min_delta)
        live = s["stop"].isNull()
        cnt = F.when(improved, F.lit(0)).otherwise(s["cnt"] + 1)
        return F.struct(
            F.when(live & improved, x["v"]).otherwise(s["best"]).alias("best"),
            F.when(live & improved, x["e"].cast("int")).otherwise(s["be"]).alias("be"),
            F.when(live, cnt).otherwise(s["cnt"]).alias("cnt"),
            F.when(live & ~improved & (cnt >= patience), x["e"].cast("int")).otherwise(s["stop"]).alias("stop"),
            (s["n"] + 1).alias("n"))
    r = fold_runs(df, run, epoch, loss, init, step, block)
    return r.select(run, F.col("s.stop").alias("stop_epoch"), F.col("s.best").alias("best_loss"),
                    F.col("s.be").alias("best_epoch"), F.col("s.n").alias("n_epochs"))


def lr_plateau(df: DataFrame, run: str, epoch: str, loss: str, lr: float = 0.001, factor: float = 0.5,
               patience: int = 2, threshold: float = 1e-4, eps: float = 1e-8, block: int | None = None) -> DataFrame:
    """Plateau schedule (mode min, relative threshold): after more than ``patience`` epochs
    without improvement the rate is multiplied by ``factor``.  Output (run, final_lr, n_reductions)."""
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("bad"), F.lit(float(lr)).alias("lr"),
                    F.lit(0).alias("red"))

    def step(s, x):
        better = x["v"] < s["best"] * F.lit(1.0 - threshold)
        bad = F.when(better, F.lit(0)).otherwise(s["bad"] + 1)
        best = F.when(better, x["v"]).otherwise(s["best"])
        cut = bad > patience
        new_lr = s["lr"] * F.lit(factor)
        applied = cut & ((s["lr"] - new_lr) > F.lit(eps))
        return F.struct(best.alias("best"), F.when(cut, F.lit(0)).otherwise(bad).alias("bad"),
                        F.when(applied, new_lr).otherwise(s["lr"]).alias("lr"),
                        (s["red"] + F.when(applied, 1).otherwise(0)).alias("red"))
    r = fold_runs(df, run, epoch, loss, init, step, block)
    return r.select(run, F.col("s.lr").alias("final_lr"), F.col("s.red").alias("n_reductions"))


def best_checkpoint(df: DataFrame, run: str, epoch: str, acc: str) -> DataFrame:
    """First epoch with the strictly greatest accuracy, among accuracies > 0 (none → no row)."""
    return (df.where(F.col(acc) > 0).groupBy(run)
            .agg(F.min_by(F.struct(F.col(epoch).alias("e"), F.col(acc).alias("a")),
                          F.struct((-F.col(acc)).alias("na"), F.col(epoch).alias("e"))).alias("b"))
            .select(run, F.col("b.e").alias("best_epoch"), F.col("b.a").alias("best_acc")))
