"""Exact deduplication against a persistent digest index.

The index is a Parquet table of one row per distinct text, bucketed and sorted
by the SHA-256 of the text.  New documents are digested, brought down to one row
per digest, and anti-joined with the index by a sort-merge join: the index is
read bucket by bucket without a shuffle, only the new digests move.  What is
left is appended to the same buckets.  The folder outlives the session
(``DigestIndex.open``).

A batch is replayed safely: its digests are written once under its name, an
entry names its batch, and a batch that has been appended is not appended again.
The text that came first stays: within a batch the row with the largest
``doc_id``, between batches the earlier batch's.

Rows of one digest may be a third of all rows.  They are counted before any
shuffle, and joined back to their entry by broadcast: a digest with more than a
``HOT``-th of all rows is in a table of at most ``HOT`` rows, whatever the size of
the corpus; the other digests go through a shuffle.

Defined results: a null text counts as empty; a null ``doc_id`` is smaller than
any other; whole rows repeated are rows of their own, of which one stays; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.missing import read_parquet_if_there
from .common import written

#: a digest with more than total / HOT rows is joined by broadcast; there are fewer than HOT of them
HOT = 4096
ENTRY = "digest binary, doc_id bigint, row bigint, batch string"


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``row`` (a number of the row in this result) and ``digest``.

    Row numbers hold only once the result is written."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest.alias("digest"))


class DigestIndex:
    """A bucketed table of digests in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = "digests_" + "".join(c if c.isalnum() else "_" for c in self.path.rsplit("/", 1)[-1])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({ENTRY}) USING parquet OPTIONS (compression 'zstd') "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/entries'")

    @classmethod
    def create(cls, spark: SparkSession, path: str, buckets: int) -> DigestIndex:
        """A new index; its number of buckets is kept beside it.  Take one for
        every 256 MB of digests at full size (40 bytes a text), and at least
        ``spark.sql.shuffle.partitions``: Spark shuffles a table of fewer buckets."""
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path.rstrip('/')}/layout")
        return cls(spark, path, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """An index that an earlier session left."""
        return cls(spark, path, spark.read.parquet(f"{path.rstrip('/')}/layout").first().buckets)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def batch(self, name: str, docs: DataFrame, text: str = "text") -> DataFrame:
        """The digests of a batch, written on its first try and read since."""
        path = f"{self.path}/batches/{name}"
        before = read_parquet_if_there(self.spark, path)
        if before is not None:
            return before
        digests(docs, text).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def unseen(self, seen: DataFrame, name: str) -> DataFrame:
        """Of a batch's digests, an entry for each that the index lacks."""
        new = seen.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("first"))
        rows = new.select("digest", "first.doc_id", "first.row", F.lit(name).alias("batch"))
        return rows.hint("merge").join(self.entries().select("digest"), "digest", "left_anti")

    def append(self, seen: DataFrame, name: str) -> None:
        """Index a batch.  Its join already deals rows by bucket, so that the
        write adds one sorted file to each bucket."""
        self.unseen(seen, name).select("digest", "doc_id", "row", "batch").write.insertInto(self.table)

    def compact(self, into: str) -> DigestIndex:
        """The same entries in a new folder, one sorted file a bucket; after many
        appends a bucket has many files."""
        new = DigestIndex.create(self.spark, into, self.buckets)
        self.entries().repartition(self.buckets, "digest").write.insertInto(new.table)
        return new

    def judged(self, seen: DataFrame, name: str) -> DataFrame:
        """Rows of a batch that was appended: ``doc_id``, ``digest``, ``keep_id``
        (of the text's entry), ``group_size`` (rows of the text in ``seen``) and
        ``kept`` (the entry is this row).  ``seen`` is a written table."""
        sizes = seen.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        groups = written(sizes.hint("merge").join(self.entries(), "digest")
                         .select("digest", "group_size", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("batch").alias("keep_batch")), "groups")
        hot = groups.where(F.col("group_size") * HOT > seen.count())
        often = seen.join(F.broadcast(hot), "digest")
        few = seen.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(groups, "digest")
        both = often.unionByName(few)
        return both.select("doc_id", "digest", "keep_id", "group_size", ((F.col("keep_batch") == name) & (F.col("keep_row") == F.col("row"))).alias("kept"))


def deduplicate(index: DigestIndex, name: str, docs: DataFrame, text: str = "text") -> DataFrame:
    """Index the batch ``name`` and return its documents' verdicts (``judged``)."""
    seen = index.batch(name, docs, text)
    index.append(seen, name)
    return index.judged(seen, name)
