"""The climate job over files as they arrive (Structured Streaming).

No new operator: the same parsing and the same station-month cube as the batch
job, maintained incrementally.  New CSV files in ``input_dir`` are parsed by the
batch column expressions; the cube aggregation keeps its state in the state
store, checkpointed under the shared checkpoint folder, so a lost executor or a
restarted query resumes without rescanning old files.  Each trigger rewrites the
cube table (stations x months rows); the six results are roll-ups of it
(``stationlens.plans.jobs.climate_results``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import parse
from ..operators.cube import station_month_cube


def stream_lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines of the ``*.csv`` files that appear in ``input_dir``."""
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir)


def _versions(spark: SparkSession, root: str) -> list:
    """Paths of the complete versions, oldest first."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/version=*/_SUCCESS")
    found = path.getFileSystem(conf).globStatus(path) or []
    return sorted((f.getPath().getParent() for f in found), key=lambda p: p.getName())


def read_cube(spark: SparkSession, cube_path: str) -> DataFrame:
    """The cube as the stream has published it last."""
    return spark.read.parquet(_versions(spark, cube_path.rstrip("/"))[-1].toString())


def start_cube_stream(spark: SparkSession, input_dir: str, cube_path: str, *, checkpoint: str | None = None,
                      max_files_per_trigger: int | None = None, trigger_seconds: int | None = None,
                      available_now: bool = False) -> StreamingQuery:
    """Start the incremental cube, published under ``cube_path`` (see :func:`read_cube`).

    Each trigger writes a version folder of its own, so readers never find a half-written
    cube; the one before stays for those who have begun to read it.  The state is
    kept beside the cube unless ``checkpoint`` names a folder, so a restart finds it again.
    """
    obs = parse.observations(stream_lines(spark, input_dir, max_files_per_trigger))
    cube = station_month_cube(obs)
    root = cube_path.rstrip("/")
    ckpt = checkpoint or f"{root}-checkpoint"

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/version={batch_id:012d}")
        for old in _versions(spark, root)[:-2]:
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    writer = cube.writeStream.outputMode("complete").option("checkpointLocation", ckpt).foreachBatch(publish)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()
