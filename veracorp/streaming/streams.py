"""Structured Streaming forms of the per-request work (ST1-ST3).

Sources are file streams over landed Parquet / text in the shared folder;
sinks are Parquet with a checkpoint location there, so a restarted query
resumes exactly where it stopped.  ``availableNow`` processes what is landed
and stops, which is how batch back-fills and tests drive them.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.operators.inference import accepted, preprocess
from veracorp.sources.feeds import feed_items, item_records


def _files(spark: SparkSession, max_files: int | None):
    """A file stream's reader; ``max_files`` per trigger only where it is given."""
    r = spark.readStream
    return r.option("maxFilesPerTrigger", max_files) if max_files else r


def run_available(stream: DataFrame, out: str, checkpoint: str) -> list[dict]:
    """Run what is landed to its end; the progress of each micro-batch."""
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return [json.loads(p.json) for p in q.recentProgress]


def preprocess_stream(spark: SparkSession, landed: str, schema: str, out: str, checkpoint: str,
                      max_files: int | None = None) -> None:                                      # ST1
    src = _files(spark, max_files).schema(schema).parquet(landed)
    p = preprocess(src, ("clean", "tokenize", "stopwords"))
    run_available(p.select("doc_id", F.array_join("tokens", " ").alias("tokens"),
                           F.array_join("removed_stopwords", " ").alias("removed_stopwords")), out, checkpoint)


def scoring_stream(spark: SparkSession, model: PipelineModel, landed: str, schema: str, out: str,
                   checkpoint: str, max_files: int | None = None) -> None:                         # ST2
    """Requests that pass validation, scored by the saved pipeline: row by row, so the stream has no state
    and the file sink writes every request once."""
    src = _files(spark, max_files).schema(schema).parquet(landed)
    scored = model.transform(accepted(src.select(F.col("doc_id").alias("request_id"), "text")))
    run_available(scored.select("request_id", "prediction", "confidence"), out, checkpoint)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_RECORD = "source string, ord long, text string, label string, date string, url string, year int, text_digest string"


def _firsts(frames):
    """The first record of every text in a batch: what a map-side combine would leave."""
    for pdf in frames:
        yield pdf.sort_values(["ord", "source", "date", "url"], na_position="first", kind="stable").drop_duplicates("text_digest")


def _first_unseen(key, frames, state):
    """The first record of a text that no earlier micro-batch had; its digest stays in the state, its text does not."""
    if state.exists:
        return
    import pandas as pd
    best = None
    for pdf in frames:
        best = next(_firsts([pdf if best is None else pd.concat([best, pdf])]))
    state.update((True,))
    yield best


def feed_dedup_stream(spark: SparkSession, landed: str, out: str, checkpoint: str,
                      max_files: int | None = None, whole_files: bool = False) -> list[dict]:       # ST3
    """Landed feed documents -> records -> one record per text, whenever it arrives.

    Digests of texts are the keys of a RocksDB state store without a watermark: a micro-batch looks up and
    stores its own digests only, whatever came before, and an item that arrives late is still told from its
    earlier copy.  Of a micro-batch's copies the first by ``ord`` is kept, nulls first, as in the batch form (D3).
    Copies are first reduced where they are read, so that a text in a third of all rows reaches its key as a row per
    Arrow batch.  The file sink and the state share the checkpoint: a restart neither loses nor repeats a record.
    Returns the progress of the micro-batches.
    """
    stream = _files(spark, max_files).option("wholetext", whole_files).text(landed)
    rec = item_records(feed_items(stream)).where(F.length("text") > 0).withColumn("text_digest", F.sha2("text", 256))
    fresh = (rec.mapInPandas(_firsts, _RECORD).groupBy("text_digest")
             .applyInPandasWithState(_first_unseen, _RECORD, "seen boolean", "append", "NoTimeout"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        return run_available(fresh, out, checkpoint)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
