"""The row-wise operators on a stream of documents.

Scores, repairs and page-wise Markdown passes are plain expressions of one row, so they run on a streaming DataFrame as they are. Passes across the pages of a
document need all its pages, which come together in one row; they are applied to each micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmill.functions.text import normalize_item
from quillmill.operators import markdown, quality


def scored(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """The stream with its quality report and repaired text; stateless."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return stream.withColumn("quality", quality.report(text)).withColumn(text_col, normalize_item(text))


def clean_markdown(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """All Markdown passes over a stream of (doc_id, markdown), written as Parquet; doc_id must be unique in a micro-batch."""

    def write(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure replaces its own folder
        markdown.clean(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
