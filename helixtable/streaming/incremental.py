"""Incremental intake: each new domain report is parsed once, also over restarts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from helixtable.sources.readers import read_domain_report

FILE = "path string, modificationTime timestamp, length long, content binary"
#: Most files whose names one batch hands to its reader.
FILES_A_BATCH = 1000


def ingest_increment(spark: SparkSession, reports: str, table: str, checkpoint: str, quarantine: str | None = None) -> None:
    """Appends the domains of report files that no earlier run has taken in to a Parquet table, and ends.

    The stream carries the names of new files alone; a batch reads them as the batch reader does, in splits and with context by
    file. Lines that could not be used go to quarantine (default: the table's name and "_quarantine"). A batch writes
    to folders of its own number and replaces what an interrupted attempt left there: a batch that runs again adds
    nothing twice.
    """
    files = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", FILES_A_BATCH).load(reports).select("path")

    def append(batch: DataFrame, number: int) -> None:
        names = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r.path) for r in batch.collect()]  # at most FILES_A_BATCH
        if names:
            good, odd = read_domain_report(batch.sparkSession, names, reports)
            good.write.mode("overwrite").parquet(f"{table}/batch={number}")
            odd.write.mode("overwrite").parquet(f"{quarantine or table + '_quarantine'}/batch={number}")

    files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
