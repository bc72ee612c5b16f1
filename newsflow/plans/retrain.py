"""Retrain when a new training collection has arrived.

One idempotent batch job (an outside scheduler decides when to call it):
poll the landing folder (U6), take the newest logged collection (S3), and unless
it has been trained on, read it (S1), run the training pipeline (M15), save the
model (S8) and record the collection as trained. Returns the hold-out metrics,
or None when nothing new arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators import updates as U
from newsflow.plans.model import TrainConfig, evaluate
from newsflow.plans.sharded import train_sharded as train
from newsflow.sources.tables import read_or_none
from newsflow.streaming.watch import last_batch, update_log, watch_collections


def retrain_if_updated(spark: SparkSession, landing: str, schema: T.StructType, state: str,
                       model_dir: str, cfg: TrainConfig | None = None,
                       fmt: str = "parquet") -> dict[str, DataFrame] | None:
    watch_collections(spark, landing, schema, state, fmt=fmt).awaitTermination()
    if last_batch(spark, state) is None:
        return None
    latest = U.latest_collection(update_log(spark, state)).first()["updated_collection"]
    if latest is None:   # nothing but empty files
        return None
    done = read_or_none(spark, f"{state}/trained", "collection string")
    if done is not None and not done.where(F.col("collection") == latest).isEmpty():
        return None
    data = (spark.read.format(fmt).schema(schema).load(f"{landing}/collection={latest}"))
    model, preds = train(data, cfg or TrainConfig())
    model.save(model_dir)
    # only now: a run that failed before this line trains again
    spark.createDataFrame([(latest,)], "collection string").write.mode("append").parquet(f"{state}/trained")
    return {k: v.select(F.lit(latest).alias("collection"), "*")
            for k, v in evaluate(preds).items()}

