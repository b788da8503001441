"""The page log as a stream: repeated deliveries dropped, the latest complete record of each page merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quirewright.operators.deliveries import message_key


def page_log(spark: SparkSession, folder: str, schema, files_per_trigger: int = 64) -> DataFrame:
    """Files of the log as they arrive; a bounded number a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_deliveries(log: DataFrame, late: str = "7 days") -> DataFrame:
    """Messages once, as they come; state is dropped behind the watermark. Rows without an identifier pass."""
    named = log.withColumn("_key", message_key("message_id")).withWatermark("delivered_at", late)
    once = named.filter("_key IS NOT NULL").dropDuplicatesWithinWatermark(["_key"])
    return once.unionByName(named.filter("_key IS NULL")).drop("_key")


def hourly_counts(log: DataFrame, late: str = "2 hours") -> DataFrame:
    """Deliveries by hour and status; late rows count until the watermark passes their hour."""
    return log.withWatermark("delivered_at", late).groupBy(F.window("delivered_at", "1 hour").alias("hour"), F.lower("status").alias("status")).count()


#: Buckets of the merged table by hash of the key; a batch rewrites those that it touches and no others.
BUCKETS = 64


def merged_latest(log: DataFrame, target: str, checkpoint: str, key: list[str], sequence: list[str], buckets: int = BUCKETS) -> StreamingQuery:
    """Runs through what has arrived and keeps the latest complete record of each key in ``target``, in buckets of the key.

    A batch reads the newest version of the buckets it touches, merges and writes them as its own version; only a version
    that is whole is read, so a batch that is run again gives the same. :func:`vacuum` drops what newer versions replace.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        place = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")
        done = batch.filter(F.lower(F.trim("status")) == "complete").select("*", place)
        touched = {r.bucket for r in done.select("bucket").distinct().collect()}  # at most ``buckets`` numbers
        if not touched:
            return
        old = {b: path for b, path in _newest(spark, target, number).items() if b in touched}
        rows = done
        if old:
            before = spark.read.schema(batch.schema).parquet(*old.values())
            rows = done.unionByName(before.select("*", place))
        columns = [c for c in rows.columns if c not in key and c != "bucket"]
        last = rows.groupBy("bucket", *key).agg(F.max_by(F.struct(*columns), F.struct(*sequence)).alias("r")).select("bucket", *key, "r.*")
        last.select("bucket", *batch.columns).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/version-{number:09d}")

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _newest(spark: SparkSession, target: str, below: int) -> dict[int, str]:
    """Folder of the newest whole version of each bucket before batch ``below``."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[int, str] = {}
    if fs.exists(path):
        names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("version-"))
        for n in names:
            if int(n[8:]) < below and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{target}/{n}/_SUCCESS")):
                for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{target}/{n}")):
                    if s.getPath().getName().startswith("bucket="):
                        out[int(s.getPath().getName()[7:])] = f"{target}/{n}/{s.getPath().getName()}"
    return out


def latest(spark: SparkSession, target: str) -> DataFrame | None:
    """The merged table as it stands; null before the first batch."""
    paths = _newest(spark, target, 10**9)
    return spark.read.parquet(*paths.values()) if paths else None


def vacuum(spark: SparkSession, target: str) -> int:
    """Drops buckets that newer versions replace, for when no batch runs; how many."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept, gone = set(_newest(spark, target, 10**9).values()), 0
    for v in fs.listStatus(path) if fs.exists(path) else []:
        for s in fs.listStatus(v.getPath()):
            at = f"{target}/{v.getPath().getName()}/{s.getPath().getName()}"
            if s.getPath().getName().startswith("bucket=") and at not in kept:
                gone += bool(fs.delete(s.getPath(), True))
    return gone
