"""Streaming forms of three batch operators.

State is kept in written tables: every micro-batch appends its own part under
its batch number, so a replayed batch overwrites itself and recovery is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.decompose import centred_moments, merge_centred
from tabulon.operators.lazy import disagreement, retention
from tabulon.operators.neighbours import VOTES, feature_array, knn


def stream_snapshot_features(stream: DataFrame, ts: str, width: str, channels: Sequence[str], delay: str,
                             by: Sequence[str] = ()) -> DataFrame:
    """Tumbling windows closed by a watermark; late rows are dropped."""
    return (stream.withWatermark(ts, delay).groupBy(*by, F.window(ts, width).alias("_w"))
            .agg(*[F.avg(F.abs(c)).alias(c) for c in channels])
            .select(*by, F.col("_w.start").alias("window_start"), *channels))


def stream_moments(stream: DataFrame, cols: Sequence[str], state_path: str, checkpoint: str, **trigger):
    """Keeps one small table of centred moments per micro-batch below ``state_path``."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        centred_moments(batch, cols).write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")
    return (stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_moments(spark: SparkSession, state_path: str) -> DataFrame:
    """Moments of all micro-batches so far, centred (which ``covariance`` uses) and
    as plain sums."""
    merged = merge_centred(spark.read.parquet(state_path).drop("batch"))
    n, a, b = F.col("n"), F.col("mean_i"), F.col("mean_j")
    return merged.select("*", (n * a).alias("sum_i"), (n * b).alias("sum_j"), (F.col("comoment") + n * a * b).alias("sum_ij"))


def stream_lazy_learner(stream: DataFrame, train: DataFrame, base_path: str, out_path: str, checkpoint: str, *,
                        key: str, features, label: str, k: int = 3, r: int = 2, vote: str = "most_voted",
                        policy: str = "nr", n_classes: int, **trigger):
    """Classify every micro-batch against the base table and append the cases
    the policy retains."""
    spark = train.sparkSession
    schema = train.select(F.col(key).alias("id"), feature_array(features).alias("x"), F.col(label).alias("label"))
    schema.write.mode("overwrite").parquet(f"{base_path}/batch=-1")

    def step(batch: DataFrame, batch_id: int) -> None:
        base = spark.read.parquet(base_path).where(F.col("batch") < batch_id).drop("batch")
        cases = batch.select(F.col(key).alias("id"), feature_array(features).alias("x"), F.col(label).alias("label"))
        near = knn(base, cases, k, r, key="id", features="x", label="label")
        info = VOTES[vote](near, k).join(disagreement(near, n_classes), "test_id").withColumnRenamed("test_id", "id")
        decided = retention(cases.join(info, "id"), policy).persist()
        decided.drop("x").write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        decided.where("retain").select("id", "x", "label").write.mode("overwrite").parquet(f"{base_path}/batch={batch_id}")
        decided.unpersist()

    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
