"""Streams of pages.

The page stage (decoding into lines, gates, anchors, bodies, columns of tables: `sources.pages.with_lines` and
`operators.page`) holds no state over rows, so `blocks_stream` is the batch plan over a stream. The operators over a row
a line (`page_gate`, `table_positions`) are windows and aggregates over pages and do not run on streams. Holdings need a
whole document, so a stream is turned into them a micro-batch at a time, each file of pages holding whole documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerleaf.plans import formats
from ledgerleaf.plans.documents import holdings_of, page_blocks
from ledgerleaf.sources.pages import with_lines

PAGES = "doc_id string, page_idx int, xml string"


def pages_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(PAGES).parquet(path)


def blocks_stream(pages: DataFrame, format_name: str) -> DataFrame:
    """The blocks of a stream of pages of one format, as a stream."""
    return page_blocks(with_lines(pages), formats.as_column(formats.SPECS[format_name]))


def holdings_stream(pages: DataFrame, format_name: str, targets: list[str], out: str, checkpoint: str, **options) -> StreamingQuery:
    """Append the holdings of each micro-batch of pages to the table at out."""

    def write(batch: DataFrame, number: int) -> None:
        # a batch that runs again replaces its own folder, so none is counted twice
        table = holdings_of(batch, format_name, targets, **options)
        table.toDF(*[c.replace(" ", "_").replace("/", "_").replace("%", "share") for c in table.columns]).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
