"""Documents to ordered chunks, and the processing queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleet_engine.functions.text import explode_each, html_blocks, text_blocks
from fleet_engine.operators.skew import salted_join
from fleet_engine.sources.bucketed import join_texts
from fleet_engine.workspace import stage


def _blocks(text, mode: str):
    if mode not in ("text", "html"):
        raise ValueError(f"unknown mode: {mode}")
    return html_blocks(text) if mode == "html" else text_blocks(text)


def flatten_array(df: DataFrame, col: str, keep: list[str], value: str = "value", index: str = "index") -> DataFrame:
    """One row per element with its position; rows with an empty or NULL array disappear."""
    return explode_each(df, keep, F.col(col), value, index)


def chunk_documents(df: DataFrame, id: str, text: str, mode: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole documents to one row per layout block, numbered from 0. Runs where the document is: no shuffle."""
    return flatten_array(df.select(id, *keep, _blocks(text, mode).alias("_blocks")), "_blocks", [id, *keep],
                         "chunk_text", "chunk_index")


def lateral_chunks(files: DataFrame, docs: DataFrame, on: str = "source_file", content: str = "content",
                   mode: str = "text") -> DataFrame:
    """Chunks of the documents that ``files`` lists, with the columns of ``files``."""
    joined = salted_join(files, docs.select(on, content), on, files.columns)
    return chunk_documents(joined, on, content, mode, tuple(c for c in files.columns if c != on))


def lateral_chunks_bucketed(files: DataFrame, table: str, on: str = "source_file", content: str = "content",
                            mode: str = "text") -> DataFrame:
    """``lateral_chunks`` over a table of ``sources.bucketed.write_texts``: the files go to the texts, and no text is shuffled."""
    joined = join_texts(files.sparkSession, files, table, on, files.columns, [content])
    return chunk_documents(joined, on, content, mode, tuple(c for c in files.columns if c != on))


def process_pending(queue: DataFrame, files: DataFrame, now: str, mode: str = "text",
                    filename: str = "filename", content: str = "content") -> tuple[DataFrame, DataFrame, DataFrame]:
    """One run over the queue: chunks, status rows and a one-row report.

    ``files`` holds one row per file name. A file that is missing or empty fails alone, with its reason; the others are
    chunked. Status rows are appended to the status log, never updated in place.
    """
    at = F.lit(now).cast("timestamp_ntz")
    pending = queue.filter(F.col("status") == "PENDING").select("ingestion_id", filename, "vin_reference")
    stored = files.select(filename, F.col(content).alias("_content"), F.lit(True).alias("_found"))
    # parsed once: chunks, status and report read what was written
    work = stage(salted_join(pending, stored, filename, "ingestion_id", how="left")
            .withColumn("_blocks", _blocks("_content", mode))
            .withColumn("error_message", F.when(F.col("_found").isNull(), "file not found")
                        .when(F.col("_content").isNull() | (F.size("_blocks") == 0), "no text in file"))
                 .drop("_content"), "parsed")
    # a failed file has no blocks, so the chunks need no look at the status
    chunks = (flatten_array(work, "_blocks", [filename, "vin_reference"], "chunk_text", "chunk_index")
              .withColumnRenamed(filename, "source_file").withColumn("extracted_at", at))
    status = work.select("ingestion_id",
                         F.when(F.col("error_message").isNull(), "COMPLETED").otherwise("FAILED").alias("status"),
                         "error_message", at.alias("processed_at"))
    report = status.agg(F.count_if(F.col("status") == "COMPLETED").alias("processed"),
                        F.count_if(F.col("status") == "FAILED").alias("failed"))
    return chunks, status, report


def latest_status(log: DataFrame, key: str = "ingestion_id", seq: str = "seq") -> DataFrame:
    """Current state per key from an append-only log; combined before the shuffle."""
    rest = [c for c in log.columns if c not in (key, seq)]
    return (log.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
            .select(key, *[F.col(f"_last.{c}").alias(c) for c in rest]))
