"""New page files to finished documents, each once, across restarts and deliveries."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.operators.documents import assemble_documents
from docengine.sources.workspace import delete, folders, get_text, put_text

PAGES = (
    T.StructType()
    .add("doc_id", "long")
    .add("page_no", "integer")
    .add("native_text", "string")
    .add("ocr_text", "string")
    .add("page_count", "integer")
)
HELD = T.StructType([*PAGES.fields, T.StructField("since", T.TimestampType())])
BUCKETS = 64
TOUCHED = "_TOUCHED"
MAX_AGE = timedelta(days=90)


def bucket() -> Column:
    """Bucket of a document's pages."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")


def _table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # not written yet
        return None


def _split(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages of documents that are all there, and those that wait for more.

    A document is complete when as many different pages are there as `page_count` says;
    of different counts the largest holds. Without a count on any page it waits.
    """
    complete = (
        pages.groupBy("doc_id")
        .agg(F.count("*").alias("here"), F.max("page_count").alias("due"))
        .where("here >= due")
        .select("doc_id")
    )
    return pages.join(complete, "doc_id", "left_semi"), pages.join(complete, "doc_id", "left_anti")


class Waiting:
    """Pages that wait for the rest of their document, in buckets by document.

    A batch writes a version of the buckets that it touches and leaves the others alone; a
    mark names the touched ones, since an empty bucket leaves no files. A bucket's state
    before a batch is in the last version before it that touched the bucket, which stays
    until the next batch that touches it is over: a batch can be repeated.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def before(self, number: int) -> dict[int, int]:
        """The last version before a batch of every bucket."""
        last: dict[int, int] = {}
        for version in sorted(int(v) for v in folders(self.spark, self.folder) if v.isdigit()):
            touched = get_text(self.spark, f"{self.folder}/{version}/{TOUCHED}")
            if version < number and touched is not None:
                last |= {bucket: version for bucket in json.loads(touched)}
        return last

    def read(self, last: dict[int, int], buckets: list[int]) -> DataFrame | None:
        """The pages that wait in some buckets."""
        paths = [
            f"{self.folder}/{last[b]}/bucket={b}"
            for b in buckets
            if b in last and f"bucket={b}" in folders(self.spark, f"{self.folder}/{last[b]}")
        ]
        return self.spark.read.schema(HELD).parquet(*paths) if paths else None

    def write(self, pages: DataFrame, number: int, buckets: list[int]) -> None:
        where = f"{self.folder}/{number}"
        held = pages.withColumn("bucket", bucket())
        held.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(where)
        put_text(self.spark, f"{where}/{TOUCHED}", json.dumps(buckets))

    def drop_passed(self, last: dict[int, int], number: int) -> None:
        """What no batch from this one on reads."""
        for version in folders(self.spark, self.folder):
            if version.isdigit() and int(version) < number:
                where = f"{self.folder}/{version}"
                if int(version) not in last.values():
                    delete(self.spark, where)
                    continue
                for name in folders(self.spark, where):
                    if last.get(int(name.partition("=")[2])) != int(version):
                        delete(self.spark, f"{where}/{name}")


def assemble_new_documents(
    spark: SparkSession,
    pages: str,
    documents: str,
    checkpoint: str,
    max_age: timedelta = MAX_AGE,
) -> None:
    """Turn page files that arrived since the last run into rows of `documents`.

    Files are remembered in `checkpoint`, so a later run reads only what is new. Pages of
    one document may come in any number of files and runs: they wait in the checkpoint
    folder, in buckets by document, until the document is complete; a batch reads and writes
    only the buckets that its own pages fall into, and one more, in turn. A page that comes
    twice counts once, as it came first. A batch that is repeated after a failure, a lost
    checkpoint (all files are read again) and pages of a finished document add nothing:
    finished documents are left out by key, of which those between the batch's least and
    largest are read.

    A document whose last page came more than `max_age` before is given up when its bucket
    is next looked at: its pages go to the table `rejected` in the checkpoint folder, a folder
    per batch. Should more of its pages come later, they wait anew.
    """
    base = checkpoint.rstrip("/")
    waiting = Waiting(spark, f"{base}/waiting")

    def step(batch: DataFrame, number: int) -> None:
        touched = {r[0] for r in batch.select(bucket()).distinct().collect()}  # at most BUCKETS
        buckets = sorted(touched | {number % BUCKETS})
        last = waiting.before(number)
        arrived = batch.withColumn("late", F.lit(1))
        held = waiting.read(last, buckets)
        if held is not None:
            arrived = arrived.unionByName(held.withColumn("late", F.lit(0)))
        done = _table(spark, documents, "doc_id long")
        if done is not None:
            low, high = arrived.agg(F.min("doc_id"), F.max("doc_id")).first()
            if low is not None:
                done = done.where(F.col("doc_id").between(low, high))
                arrived = arrived.join(done, "doc_id", "left_anti")
        first = F.min(F.struct("late", "native_text", "ocr_text")).alias("first")
        known = arrived.groupBy("doc_id", "page_no").agg(
            first, F.max("page_count").alias("page_count"), F.min("since").alias("since")
        )
        known = known.select(
            "doc_id", "page_no", "first.native_text", "first.ocr_text", "page_count", "since"
        )
        complete, rest = _split(known)
        oldest = F.lit(datetime.now(timezone.utc) - max_age)
        given_up = rest.groupBy("doc_id").agg(F.max("since").alias("newest"))
        given_up = given_up.where(F.col("newest") < oldest).select("doc_id")
        # What waits is written first: it does not depend on what this batch finishes.
        waiting.write(rest.join(given_up, "doc_id", "left_anti"), number, buckets)
        rejected = rest.join(given_up, "doc_id", "left_semi")
        rejected.write.mode("overwrite").parquet(f"{base}/rejected/batch={number}")
        assemble_documents(complete).write.mode("append").parquet(documents)
        waiting.drop_passed(last, number)

    # The time at which a page's file came, which a repeated batch sees again.
    since = F.col("_metadata.file_modification_time").alias("since")
    query = (
        spark.readStream.schema(PAGES)
        .parquet(pages)
        .select(*PAGES.names, since)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
