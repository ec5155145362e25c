"""New page files merged into the main table as they land.

The batch pipeline as an incremental one: Structured Streaming remembers which files it has
read, every micro-batch goes through the same staging, audit and merge, and a batch that is
repeated after a failure changes nothing, because the merge only takes newer versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketmill import schemas as S
from ticketmill.operators import ingest
from ticketmill.plans import loads
from ticketmill.plans.publish import merge_into, written
from ticketmill.sources import pages, table


def merge_landed_pages(spark: SparkSession, lake: loads.Lake, pages_dir: str, checkpoint: str,
                       max_files: int = 1000) -> StreamingQuery:
    """Start a query that takes all files not read so far, in batches, and then ends.

    Records that do not parse, or have no readable creation time, go to the quarantine, from where
    they can be replayed; the rest of their batch is loaded. A batch that fails its audit stops the
    query with the main table as it was; the same files are tried again by the next start.
    """
    loads.ensure_tables(spark, lake)

    def take(raw: DataFrame, batch_id: int) -> None:
        session = raw.sparkSession
        parses = pages.readable("created_date") & (ingest.parse_errors(raw) == 0)
        with written(session, loads.split(raw, parses, F.lit(0))) as outcomes:
            loads.set_aside(session, lake, outcomes, f"feed batch {batch_id}", "does not parse")
            if not loads.stage(session, lake, outcomes.where("_chunk = 0")):
                return
        if not loads.audit_passes(session, lake):
            raise ValueError(f"audit failed for batch {batch_id}")
        merge_into(session, lake.main, table.read(session, lake.staging))
        table.truncate(session, lake.staging)

    landed = (
        spark.readStream.schema(S.RAW_SCHEMA).option("maxFilesPerTrigger", max_files)
        .json(pages_dir)
    )
    return (
        landed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
