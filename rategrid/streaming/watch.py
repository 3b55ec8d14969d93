"""The same operators over files as they arrive.

The operators take and give DataFrames, so the narrow ones run on a stream as they
are; only the bands keep state, two amounts and two counts per (state, band).
Offsets and state live in a checkpoint in the shared folder, from which a query
goes on after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rategrid import schemas
from rategrid.operators.bands import BAND_KEYS, band_parts, clean_salaries, finish_bands
from rategrid.operators.sections import cut_text, section_rows
from rategrid.sources.readers import missing_to_null


def arriving_salaries(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Salary rows of the CSV files in a folder, new ones as they come."""
    raw = (
        spark.readStream.schema(schemas.SALARIES_RAW)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(
            folder, header=True, nullValue="NA",
            ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
        )
    )
    return clean_salaries(missing_to_null(raw))


def band_updates(salaries: DataFrame, na: str = "propagate") -> DataFrame:
    """Bands over all rows so far, for update or complete output."""
    return finish_bands(band_parts(salaries, BAND_KEYS), BAND_KEYS, na)


def arriving_sections(documents: DataFrame, layouts: DataFrame) -> DataFrame:
    """Section lines of arriving documents (state, doc_id, text), one row each; no state."""
    return section_rows(cut_text(documents.join(layouts, "state", "left")))


def keep_bands(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the bands after each batch, newest result in the highest ``batch`` folder.

    A batch that is run again after a failure writes the same folder again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("written", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )

    return (
        updates.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
