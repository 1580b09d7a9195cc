"""Exact de-duplication over a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A batch of documents is reduced to one row a
digest (partial aggregation first, so a text that fills a third of the batch costs one row a task), held
against the index by a sort-merge join that reads the index in place, and the digests it did not
have are appended.  DataFrame operations only.

Looking the decision up for each row would put all rows of a very frequent text into one task, so digests
with more than 1/512 of the batch's rows are joined by broadcast.  There are at most 512 of these, whatever
the batch.

Recovery and re-opening.  A folder holds the index: ``data`` (the table), ``log`` (a file for every batch, numbered) and
``layout.json`` (bucket count), which is written once and obeyed by whoever opens the folder later; another
bucket count is refused, and on opening every digest must lie in its bucket.  A batch's digests are
written under an attempt of their own, and count from the moment its log file exists; what a failed writer left is never
read.  Of two writers at once, one creates the next log file; the other decides again.  A batch that is run
again under the same ``batch_id`` is decided as before, so that a job which fails after its append and
before it wrote its result loses nothing.  (Creating a file that must not exist is atomic on HDFS; an
object store needs one writer at a time.)

Two texts are equal if they are identical after each run of ASCII white space became one space.  Defined
results: null counts as the empty text; of equal texts the smallest id stays (null ids last), and of rows
that share this id too, one; a text that another batch brought is dropped whatever its id; an empty batch
gives an empty result and appends nothing; texts of any length are read whole; ``drop_copies`` keeps further columns
whatever their names, the others don't read them.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import SPACE, clean_text, materialise

#: A digest is looked up by broadcast if it has more than this share of a batch's rows.
HOT_SHARE = 1 / 512


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(clean_text(text_col), SPACE, " ")


def digest(text_col: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(text_col), 256))


class DigestIndex:
    """Index (digest, keep_id, group_size) in the folder ``path``; opened again by the same path."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or f"{ensure_checkpoint_dir(spark)}/digests-{uuid.uuid4().hex}").rstrip("/")
        self.name = f"digests_{uuid.uuid4().hex}"
        layout = f"{self.path}/layout.json"
        if not self._exists(layout):
            if self._exists(f"{self.path}/data"):
                raise ValueError(f"{self.path} has data but no layout.json, so its buckets aren't known")
            wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            self._create(layout, json.dumps({"format": 1, "buckets": wanted}))
        known = json.loads(self._read(layout))
        if known.get("format") != 1:
            raise ValueError(f"{layout}: format {known.get('format')} isn't known")
        self.buckets = int(known["buckets"])
        if buckets not in (None, self.buckets):
            raise ValueError(f"{self.path} has {self.buckets} buckets, not {buckets}")
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, group_size BIGINT, attempt STRING) "
                  f"USING PARQUET CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}/data'")
        self.check()

    def close(self) -> None:
        """Drop the catalog entry; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def check(self) -> None:
        """Every digest must be in the bucket that a join will look for it in."""
        bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.c\d+", 1).cast("int")
        wrong = self.spark.table(self.name).filter(
            ~bucket.eqNullSafe(F.pmod(F.hash("digest"), F.lit(self.buckets)))).limit(1).count()
        if wrong:
            self.close()
            raise ValueError(f"{self.path} has digests outside their buckets")

    # -- small files, in the file system of the path

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _read(self, path: str) -> str:
        return "".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect())

    def _create(self, path: str, text: str) -> bool:
        """Write a new file; False if it is there already."""
        fs, target = self._fs(path)
        try:
            out = fs.create(target, False)
        except Py4JJavaError as error:
            if fs.exists(target):
                return False
            raise error
        out.write(text.encode())
        out.close()
        return True

    def batches(self) -> list[dict]:
        """What was committed, in order: {"batch", "attempt"}."""
        fs, folder = self._fs(f"{self.path}/log")
        if not fs.exists(folder):
            return []
        names = sorted(f.getPath().toString() for f in fs.listStatus(folder))
        rows = self.spark.read.text(names, wholetext=True).select("value", "_metadata.file_name").collect() if names else []
        return [json.loads(r.value) for r in sorted(rows, key=lambda r: r.file_name)]

    def read(self, besides: str | None = None) -> DataFrame:
        """(digest, keep_id, group_size) of all committed batches but ``besides``."""
        attempts = [b["attempt"] for b in self.batches() if b["batch"] != besides]
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).filter(F.col("attempt").isin(attempts)).drop("attempt")

    def resolve(self, groups: DataFrame, batch_id: str) -> DataFrame:
        """``groups`` with ``known_id`` and ``known_size`` of the batch that brought a digest first, if that is
        another one; adds this batch's digests."""
        while True:
            log = self.batches()
            known = self.read(besides=batch_id).withColumnsRenamed({"keep_id": "known_id", "group_size": "known_size"})
            found = materialise(groups.repartition(self.buckets, "digest").hint("merge").join(known, "digest", "left"),
                                "digests-found")
            if any(b["batch"] == batch_id for b in log):
                return found
            attempt = uuid.uuid4().hex
            new = found.filter("known_size IS NULL").repartition(self.buckets, "digest")
            (new.select("digest", "keep_id", "group_size", F.lit(attempt).alias("attempt")).write.format("parquet")
                .bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.name))
            if self._create(f"{self.path}/log/{len(log):09d}.json", json.dumps({"batch": batch_id, "attempt": attempt})):
                return found


def decide(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
           batch_id: str | None = None) -> DataFrame:
    """(row, id_col, digest, keep_id, group_size, kept) for each row of ``docs``; appends to the index.

    ``group_size`` counts the rows of the batch in which the text was first seen.  Without a ``batch_id`` each call is
    a batch of its own.
    """
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                   digest(text_col).alias("digest")), "digest-rows")
    groups = materialise(
        rows.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "row")).alias("first"),
                                   F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"),
                    "group_size"), "digest-groups")
    batch = batch_id or uuid.uuid4().hex
    found = index.resolve(groups, batch)
    old = F.col("known_size").isNotNull()
    found = found.select("digest", F.when(old, F.col("known_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.when(~old, F.col("keep_row")).alias("keep_row"), F.col("group_size").alias("here"),
                         F.coalesce("known_size", "group_size").alias("group_size"))
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("here") > F.lit(total * HOT_SHARE)  # 1 / HOT_SHARE rows at most
    hot, rest = found.filter(is_hot).drop("here"), found.filter(~is_hot).drop("here")
    all_rows = rows.join(F.broadcast(hot), "digest").unionByName(
        rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").hint("merge").join(rest, "digest"))
    return all_rows.select("row", F.col("id").alias(id_col), "digest", "keep_id", "group_size",
                           F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"))


def drop_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                batch_id: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose texts are new to the index, one row a text, with all columns of ``docs``.

    Texts are shuffled once: repeated rows are combined in their task, the kept (id, digest) pairs are
    unique, so no key is hot.
    """
    kept = decide(docs, index, id_col, text_col, batch_id).filter("kept").select(
        F.col(id_col).alias("_id"), F.col("digest").alias("_digest"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), digest(text_col).alias("_digest"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    once = rows.groupBy("_id", "_digest").agg(F.any_value("_doc").alias("_doc"))
    same = once["_id"].eqNullSafe(kept["_id"]) & (once["_digest"] == kept["_digest"])
    return once.join(kept, same, "left_semi").select("_doc.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document, against an empty index."""
    index = DigestIndex(docs.sparkSession)
    found = decide(docs, index)
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
