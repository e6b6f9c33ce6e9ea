"""V06 in the stream: images that arrive before, with or after their study.

Studies that pass V01 and images are two file streams, joined on the study key within
event-time bounds: an image waits in the join's state until the watermark has passed its
time by ``bound_days``; then it comes out unlinked. V02 needs no part here, as it keeps one
row of every key that passes V01: ``dropDuplicatesWithinWatermark`` does the same for keys.

``delay_days`` is how late a row may come; later ones are dropped by the watermark, as in any
Spark stream. It must be more than twice the bound: then a key's next copy enters only when
the images that met the first have left, and each image comes out once. An image links to a
study as in the batch if their times, and those of the study's copies, lie within the bound.

A null key equals a null key, as in the batch; rows without a time are not extracted (E1, E2);
equal images are all kept. Each micro-batch overwrites its own folder, so a replay changes
nothing; a folder of outputs belongs to one checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera import config as C
from tessera.config import JobConfig
from tessera.operators import extract, quality
from tessera.session import session_conf

HEARTBEAT = "\x00heartbeat"
#: Two versions of the waiting rows in memory double the entries that each collection walks over;
#: a version that is asked for again is read from the checkpoint.
STATE_CONF = {"spark.sql.streaming.maxBatchesToRetainInMemory": "1"}


def linked_stream(images: DataFrame, studies: DataFrame, bound_days: int, delay_days: int,
                  watermark: str = C.INITIAL_WATERMARK, cfg: JobConfig = C.DEFAULT) -> DataFrame:
    """Image columns and ``linked``, from two streams with typed times."""
    if delay_days <= 2 * bound_days:
        raise ValueError("delay_days must be more than twice bound_days")
    if clash := {"linked", "epoch"} & set(images.columns):
        raise ValueError(f"images may not have columns {sorted(clash)}")
    delay, bound = f"{delay_days} days", F.expr(f"INTERVAL {bound_days} DAYS")
    known = extract.extract_ris(studies, watermark, cfg)
    known = (known.where(~quality.v01_null_timestamps(known, cfg))
             .select(F.coalesce(F.col(cfg.key_col), F.lit("")).alias("_key"), F.col(cfg.key_col).isNull().alias("_none"),
                     F.col(cfg.start_col).cast("timestamp").alias("_start"))
             .withWatermark("_start", delay).dropDuplicatesWithinWatermark(["_key", "_none"]))
    seen = (extract.extract_pacs(images, watermark, cfg)
            .withColumn("_taken", F.col(cfg.pacs_time_col).cast("timestamp")).withWatermark("_taken", delay))
    key = seen[cfg.pacs_key_col]
    on = ((F.coalesce(key, F.lit("")) == known["_key"]) & (key.isNull() == known["_none"])
          & (seen["_taken"] >= known["_start"] - bound) & (seen["_taken"] <= known["_start"] + bound))
    return seen.join(known, on, "left_outer").select(
        *[seen[c] for c in images.columns], known["_start"].isNotNull().alias("linked"))


def start_linkage(spark: SparkSession, image_dir: str, study_dir: str, root: str, checkpoint: str,
                  image_schema: StructType, study_schema: StructType, bound_days: int = 2, delay_days: int = 7,
                  watermark: str = C.INITIAL_WATERMARK, cfg: JobConfig = C.DEFAULT,
                  max_files_per_trigger: int = 1, available_now: bool = True) -> StreamingQuery:
    """Write V06 outcomes of two folders of files under ``root``; read them with :func:`outcomes`."""
    def source(folder: str, schema: StructType) -> DataFrame:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)

    out = linked_stream(source(image_dir, image_schema), source(study_dir, study_schema), bound_days, delay_days, watermark, cfg)
    spark.createDataFrame([], out.schema).write.mode("overwrite").parquet(f"{root}/epoch=-1")

    def process(batch: DataFrame, epoch_id: int) -> None:
        heard = F.coalesce(F.col(cfg.pacs_key_col) == HEARTBEAT, F.lit(False))
        batch.where(~heard).write.mode("overwrite").parquet(f"{root}/epoch={epoch_id}")

    writer = out.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    with session_conf(spark, STATE_CONF):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Images that have come out so far, with ``linked``."""
    return spark.read.parquet(root).drop("epoch")


def heartbeat(spark: SparkSession, image_dir: str, study_dir: str, image_schema: StructType,
              study_schema: StructType, at: str, cfg: JobConfig = C.DEFAULT) -> None:
    """A row of time ``at`` for both streams, which moves the watermark of sources that send no
    more rows, so that waiting images come out. It reaches no output."""
    for folder, schema, key, times in ((image_dir, image_schema, cfg.pacs_key_col, (cfg.pacs_time_col,)),
                                       (study_dir, study_schema, cfg.key_col, {cfg.start_col, *cfg.required_ts_cols})):
        cols = [F.lit(HEARTBEAT if f.name == key else at if f.name in times else None).cast(f.dataType).alias(f.name)
                for f in schema]
        spark.range(1).select(*cols).coalesce(1).write.mode("append").parquet(folder)
