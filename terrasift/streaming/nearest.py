"""Nearest-in-time pairing of two tables by a stateful streaming join.

Both tables are replayed in event time as two streams. A stream-stream join buffers both sides per
(entity, time bucket) and drops a row once the watermark has passed its tolerance horizon; a stateful
minimum over the join's candidates emits a left row's nearest partner when the watermark passes that
horizon. State therefore holds what lies within the tolerance and one micro-batch, not the tables, and a
hot entity is spread over its time buckets.

The replay is what makes lateness harmless: rows are range-partitioned by event time first, so a row
that was delivered late still arrives in its place and none is dropped as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove, scratch

BATCHES = 2  #: micro-batches of a replay, at least
FILE_ROWS = 500_000  #: rows of one replay file, at most
BATCH_ROWS = 20_000_000  #: rows of one side in a micro-batch, at most about: larger tables take more batches
STATE_ROWS = 100_000  #: rows of a micro-batch per task, about
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  #: Spark's state store on disk
BUCKET_CS = 6_000  #: width of a time bucket
CLOCK_MS = 1_000_000_000_000
END = "9999-01-01 00:00:00"


def bounds(events: DataFrame) -> DataFrame:
    """One row per non-null bound of a stage event: (event_id, run_id, edge, t_cs)."""
    cs = lambda c: F.round(F.col(c) * 100).cast("long")
    both = F.array(F.struct(F.lit("start").alias("edge"), cs("start_s").alias("t_cs")), F.struct(F.lit("end").alias("edge"), cs("end_s").alias("t_cs")))
    return events.select("event_id", "run_id", F.inline(both)).where("t_cs is not null and run_id is not null and event_id is not null")


def _replay(spark: SparkSession, df: DataFrame, path: str, ts: str, batches: int, no_run: int) -> tuple[int, int]:
    """Writes ``df`` as files in event-time order; gives the number of files and of rows per micro-batch.

    A row far in the future ends the data and drives the watermark past every real row; what follows it
    is a batch of its own, in which the last rows come out. File sources take files by modification
    time, so that is set to follow the range order. The added rows have no nulls (the join's null filter
    would take them out below the watermark) and a run of their own on each side, so they pair with nothing.
    """
    one = spark.range(1, numPartitions=1)
    end = one.select(*(F.lit(END).cast("timestamp").alias(f.name) if f.name == ts else F.lit(no_run if f.name == "run_id" else 0).cast(f.dataType).alias(f.name) for f in df.schema))
    rows = df.count()  # of two or three columns; files and tasks follow from it
    batches = max(batches, -(-rows // BATCH_ROWS))
    parts = max(4 * batches, -(-rows // FILE_ROWS))
    df.unionByName(end).repartitionByRange(parts, ts).sortWithinPartitions(ts).write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)
    files = sorted(str(s.getPath()) for s in fs.listStatus(at(path)) if s.getPath().getName().endswith(".parquet"))
    per = -(-len(files) // batches)
    for k in range(-len(files) % per + 1):
        end.write.parquet(f"{path}-end")
        last = next(str(s.getPath()) for s in fs.listStatus(at(f"{path}-end")) if s.getPath().getName().endswith(".parquet"))
        fs.rename(at(last), at(f"{path}/zz-{k:06d}.parquet"))
        fs.delete(at(f"{path}-end"), True)
        files.append(f"{path}/zz-{k:06d}.parquet")
    for k, f in enumerate(files):
        fs.setTimes(at(f), 1_600_000_000_000 + k * 60_000, -1)
    return per, rows * per // len(files)


def nearest_samples(spark: SparkSession, left: DataFrame, samples: DataFrame, tolerance_cs: int, batches: int = BATCHES) -> DataFrame:
    """(event_id, edge, sample_id): for each row of ``left`` the nearest sample of the same run within the tolerance.

    ``left`` has (event_id, run_id, edge, t_cs), ``samples`` (sample_id, run_id, t_cs), times in whole
    hundredths. Ties in distance go to the earlier sample, then to the smaller id. Rows with a null key or
    time take no part; repeated rows count once; bounds without a sample in reach give no row; empty
    tables give no rows; other columns are ignored. Times of different runs share one clock here, which is
    harmless: pairs are made within a run only.
    """
    root = scratch(spark, "nearest")
    # the stream's clock: a watermark starts at 1970, so times count from well after it
    clock = F.timestamp_millis(F.col("t_cs") * 10 + CLOCK_MS)
    lt = left.select("event_id", "edge", "run_id", "t_cs").where("event_id is not null and run_id is not null and t_cs is not null").select("*", clock.alias("l_ts"))
    rt = samples.select("sample_id", "run_id", "t_cs").where("sample_id is not null and run_id is not null and t_cs is not null").select("*", clock.alias("r_ts"))
    per = [_replay(spark, lt, f"{root}/left", "l_ts", batches, -1), _replay(spark, rt, f"{root}/right", "r_ts", batches, -2)]
    # a session of its own, so that the stream's settings stay its own
    own = spark.newSession()
    at_once = sum(rows for _, rows in per)
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(spark.sparkContext.defaultParallelism, -(-at_once // STATE_ROWS)))
    settings = {"spark.sql.shuffle.partitions": tasks, "spark.sql.streaming.minBatchesToRetain": 2}  # not a hundred batches of state files
    settings |= {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    if at_once > tasks * STATE_ROWS * 2:  # more than fits the heap beside everything else
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKS
    for k, v in settings.items():
        own.conf.set(k, str(v))
    # a candidate may come from the batch after its left row's, one tolerance later; the delay keeps that row open
    delay = f"{2 * tolerance_cs * 10 + 1000} milliseconds"
    ls = own.readStream.schema(lt.schema).option("maxFilesPerTrigger", per[0][0]).parquet(f"{root}/left").withWatermark("l_ts", delay)
    rs = own.readStream.schema(rt.schema).option("maxFilesPerTrigger", per[1][0]).parquet(f"{root}/right").withWatermark("r_ts", delay)
    near = lambda c, d: F.floor((F.col(c) + d) / BUCKET_CS).cast("long")
    ls = ls.withColumn("bucket", F.explode(F.array_distinct(F.array(near("t_cs", -tolerance_cs), near("t_cs", tolerance_cs)))))
    ls = ls.select(F.col("run_id").alias("l_run"), "bucket", "event_id", "edge", F.col("t_cs").alias("l_cs"), "l_ts")
    rs = rs.select(F.col("run_id").alias("r_run"), near("t_cs", 0).alias("r_bucket"), "sample_id", F.col("t_cs").alias("r_cs"), "r_ts")
    reach = f"interval {tolerance_cs * 10} milliseconds"
    pairs = ls.join(rs, F.expr(f"l_run = r_run and bucket = r_bucket and r_ts >= l_ts - {reach} and r_ts <= l_ts + {reach}"))
    best = F.min(F.struct(F.abs(F.col("l_cs") - F.col("r_cs")).alias("d"), F.col("r_cs").alias("at"), "sample_id")).alias("b")
    out = pairs.groupBy("l_ts", "event_id", "edge").agg(best).select("event_id", "edge", F.col("b.sample_id").alias("sample_id"))
    q = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/state").option("path", f"{root}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    for part in ("left", "right", "state"):
        remove(spark, f"{root}/{part}")
    return spark.read.schema("event_id long, edge string, sample_id long").parquet(f"{root}/out")
