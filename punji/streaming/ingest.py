"""Extract documents that arrive as files, upserted into the pages table batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from punji.functions.text import edition_id_of
from punji.operators.tables import latest, upsert
from punji.runtime import cut
from punji.sources.archive_io import EXTRACT, extract_pages, write_table

KEYS = ["edition_id", "page_number"]


def ingest_extracts(spark: SparkSession, source: str, target: str, state: str) -> StreamingQuery:
    """Starts a query that reads new files of ``source`` once and upserts their pages into ``target``.

    Of a page that comes several times in a batch the one in the newest file counts, of equal times the greater name.
    Pages of an edition that came in earlier batches stay unless they come again. A batch that runs again writes the
    same partitions, so a restart from ``state`` neither loses nor repeats pages.
    """
    arriving = spark.readStream.schema(EXTRACT).option("multiLine", True).json(source)
    named = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"))
    arriving = arriving.withColumn("edition_id", edition_id_of(F.coalesce("pdf_path", F.col("_metadata.file_path")))).withColumn("arrived", named)

    def store(batch: DataFrame, _: int) -> None:
        pages = latest(extract_pages(batch).where("page_number is not null"), KEYS, [F.col("arrived")]).drop("arrived")
        try:
            before = spark.read.parquet(target)
        except AnalysisException:  # nothing was stored yet
            before = None
        if before is not None:  # only the partitions of the batch's editions are read and written
            pages = upsert(before.join(pages.select("edition_id").distinct(), "edition_id", "left_semi").select(*pages.columns), pages, KEYS)
        write_table(cut(pages), target)

    return arriving.writeStream.foreachBatch(store).option("checkpointLocation", state).trigger(availableNow=True).start()
