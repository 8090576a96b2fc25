"""Restart-safe sink for scored messages (I1, I2, B2): every alert once, whatever fails.

Each micro-batch is written to a folder of its own (``alerts/batch=<id>``), replacing what an
earlier attempt left there, and then entered in a ledger: one row with the batch, the stream it
belongs to and the counts observed while it was written (no second pass over the alerts). A
batch stands only once its entry does. A replayed batch with an entry is left alone, one
without is written anew; the source replays the same rows for the same batch id, so a job that
was stopped anywhere ends with each alert once. Readers take the batches of the ledger only.

The ledger holds one small file a batch. A ledger belongs to one checkpoint: batch ids of
another would start again at 0, so a different or lost checkpoint is refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowml.operators.sampling import literal_table
from flowml.session import path_exists

BATCH = "batch"


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark stored in a checkpoint folder; None before the first start."""
    path = f"{checkpoint}/metadata"
    if not path_exists(spark, path):
        return None
    return json.loads(spark.read.text(path).first()[0])["id"]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch: batch, stream and the counts."""
    return spark.read.parquet(f"{path}/ledger")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts of committed batches. A batch that was stopped half-way is not seen."""
    alerts = spark.read.parquet(f"{path}/alerts")
    return alerts.join(read_ledger(spark, path).select(BATCH), BATCH, "left_semi")


def write_batch(alerts: DataFrame, batch: int, path: str, checkpoint: str,
                counts: Mapping[str, Column], after_write: Callable[[int], None] | None = None) -> bool:
    """Write and enter one batch; False where the ledger has it already."""
    spark = alerts.sparkSession
    entry = f"{path}/ledger/{BATCH}={batch}"
    if path_exists(spark, f"{entry}/_SUCCESS"):
        return False
    seen = Observation()
    alerts.observe(seen, *[c.cast("long").alias(n) for n, c in counts.items()]) \
        .write.mode("overwrite").parquet(f"{path}/alerts/{BATCH}={batch}")
    if after_write is not None:
        after_write(batch)
    names = ", ".join(f"`{n}` long" for n in counts)
    row = (stream_id(spark, checkpoint), *[seen.get.get(n, 0) for n in counts])
    literal_table(spark, f"stream string, {names}", [row]).coalesce(1).write.mode("overwrite").parquet(entry)
    return True


def start_ledgered(alerts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   counts: Mapping[str, Column] | None = None, query_name: str | None = None,
                   after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start (or restart) a job that writes ``alerts`` under ``path``.

    ``counts``: aggregates to enter per batch (default: ``rows``, and ``unreadable`` where the
    alerts have ``parse_ok``). ``after_write`` is called with the batch id between the alerts
    and their ledger entry; an exception there stops the job with the batch not committed.
    """
    spark = alerts.sparkSession
    if counts is None:
        counts = {"rows": F.count(F.lit(1))}
        if "parse_ok" in alerts.columns:
            counts["unreadable"] = F.count_if(~F.col("parse_ok"))
    if path_exists(spark, f"{path}/ledger"):
        # An entry that was never finished leaves a folder without files: no schema, no stream.
        done = spark.read.schema("stream string").parquet(f"{path}/ledger")
        others = done.where(~F.col("stream").eqNullSafe(F.lit(stream_id(spark, checkpoint))))
        if not others.isEmpty():
            raise ValueError(f"the ledger under {path!r} belongs to another checkpoint than {checkpoint!r}")
    writer = (alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, batch: write_batch(df, batch, path, checkpoint, counts, after_write) and None))
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
