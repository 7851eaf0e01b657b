"""The index as parquet tables under one folder.

Every sync appends one *segment* of each table and then publishes a commit
row; readers see only the segments of the newest commit, so a failed run
leaves nothing visible and its rerun overwrites the same folders.

=========  ==================================================================
forward    one row per document: id, path, title, hash, its postings
docs       ``doc_id, path, title, content_md5, file``, folders by hash of doc_id;
           ``file`` is the document's file of ``forward``
postings   ``field, term, doc_id, tf, positions, ...``, folders by hash of term
terms      ``field, term, df, ttf, lead_docs, max_tf, min_dl_q``: deltas and
           bounds, folders by hash of term
fields     ``field, doc_count, sum_dl``: deltas
dead       ``doc_id, segment`` of replaced and removed documents
changes    ``path, state``: what each sync found
seen       ``path, ts, hash``: the newest version of a path that a feed brought
commits    one row per sync
=========  ==================================================================

A query reads the folders of its terms only, and in them, sorted by field and
term, the row groups that can hold them.  A frequent term fills many files of
its folder, so it is read by many tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordloom.operators import postings as P

RUNS = "array<struct<term: string, tf: int, positions: array<int>>>"
SCHEMAS = {
    "docs": "doc_id bigint, path string, title string, content_md5 string, file string, segment int, shard int",
    "postings": "field string, term string, doc_id bigint, tf int, positions array<int>, "
    "dl int, dl_q int, lead boolean, segment int, bucket int",
    "terms": "field string, term string, df bigint, ttf bigint, lead_docs bigint, max_tf int, min_dl_q int, segment int, bucket int",
    "fields": "field string, doc_count bigint, sum_dl bigint, segment int",
    "dead": "doc_id bigint, segment int, version int",
    "changes": "path string, state string, old_doc_id bigint, old_segment int, old_file string, version int",
    "commits": "segments array<int>, n_dead bigint, fields array<string>, buckets int, shards int, version int",
}


# Up to this many files of documents are read by name, beyond it all of them.
NAMED_FILES = 10_000


@dataclass(frozen=True)
class Commit:
    version: int = 0
    segments: tuple[int, ...] = ()
    n_dead: int = 0


class IndexStore:
    """Readers and writers of the tables; ``sync`` and ``search`` drive it.

    ``buckets`` is the number of term folders and ``shards`` that of document
    folders; choose them so that a folder holds a few files of the size the
    file system likes (thousands for a very large corpus).  The layout is part
    of the index: a store that exists is opened without these arguments, and
    one that differs from it is an error.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fields: Sequence[str] | None = None,
        buckets: int | None = None,
        shards: int | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        newest = self._newest()
        given = {"fields": fields and list(fields), "buckets": buckets, "shards": shards}
        for name, default in (("fields", list(P.FIELDS)), ("buckets", 16), ("shards", 8)):
            stored = newest and newest[name]
            if stored and given[name] and stored != given[name]:
                raise ValueError(f"the index at {self.root} has {name} {stored}, not {given[name]}")
            given[name] = stored or given[name] or default
        self.fields = tuple(given["fields"])
        self.buckets = given["buckets"]
        self.shards = given["shards"]

    # -- layout -------------------------------------------------------------

    def bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def shard(self, doc_id: Column) -> Column:
        return F.pmod(F.xxhash64(doc_id), F.lit(self.shards)).cast("int")

    def _folder(self, table: str, part: str, number: int) -> str:
        return f"{self.root}/{table}/{part}={number}"

    def _read(self, table: str, part: str, numbers: Sequence[int]) -> DataFrame:
        schema = SCHEMAS.get(table) or self._forward_schema()
        if not numbers:
            return local_rows(self.spark, [], schema)
        return (
            self.spark.read.schema(schema)
            .option("basePath", f"{self.root}/{table}")
            .parquet(*[self._folder(table, part, n) for n in numbers])
        )

    def _forward_schema(self) -> str:
        runs = ", ".join(f"runs_{f} {RUNS}" for f in self.fields)
        return f"doc_id bigint, path string, title string, content_md5 string, {runs}, segment int"

    # -- readers ------------------------------------------------------------

    def commit(self) -> Commit:
        """The newest commit; an empty one where there is no index yet."""
        newest = self._newest()
        return Commit(newest["version"], tuple(newest["segments"]), newest["n_dead"]) if newest else Commit()

    def _newest(self) -> Row | None:
        folder = f"{self.root}/commits"
        if not _exists(self.spark, folder):
            return None
        commits = self.spark.read.schema(SCHEMAS["commits"]).parquet(folder)
        return commits.orderBy(F.desc("version")).first()

    def dead(self, at: Commit) -> DataFrame:
        return self._read("dead", "version", [at.version] if at.n_dead else []).select("doc_id", "segment")

    def _live(self, table: str, at: Commit) -> DataFrame:
        rows = self._read(table, "segment", at.segments)
        if not at.n_dead:
            return rows
        return rows.join(self.dead(at), ["doc_id", "segment"], "left_anti")

    def docs(self, at: Commit | None = None) -> DataFrame:
        return self._live("docs", at or self.commit())

    def manifest(self, at: Commit | None = None) -> DataFrame:
        return self.docs(at).select("path", "content_md5")

    def postings(self, at: Commit | None = None) -> DataFrame:
        return self._live("postings", at or self.commit())

    def forward(self, at: Commit | None = None) -> DataFrame:
        return self._live("forward", at or self.commit())

    def forward_of(self, at: Commit, documents: DataFrame) -> DataFrame:
        """Stored documents ``doc_id, segment, file``; only their files are read."""
        named = documents.select("segment", "file").distinct().limit(NAMED_FILES + 1).collect()
        if not named:
            stored = self._read("forward", "segment", [])
        elif len(named) <= NAMED_FILES:
            folder = f"{self.root}/forward"
            files = [f"{self._folder('forward', 'segment', r['segment'])}/{r['file']}" for r in named]
            stored = self.spark.read.schema(self._forward_schema()).option("basePath", folder).parquet(*files)
        else:
            stored = self._read("forward", "segment", at.segments)
        return stored.join(documents.select("doc_id", "segment"), ["doc_id", "segment"], "left_semi")

    def segment_documents(self, segment: int) -> DataFrame:
        """``doc_id, path, title, content_md5, file`` of one stored segment."""
        forward = self._read("forward", "segment", [segment])
        return forward.select("doc_id", "path", "title", "content_md5", F.col("_metadata.file_name").alias("file"))

    def seen(self) -> DataFrame | None:
        """``path, ts, hash`` of what feeds brought; several rows for a path."""
        folder = f"{self.root}/seen"
        return self.spark.read.parquet(folder).drop("batch") if _exists(self.spark, folder) else None

    def stamps(self) -> tuple[int, DataFrame | None]:
        """Number and rows ``path, length, modified, content_md5`` of the newest stamps of files."""
        folder = f"{self.root}/stamps"
        if not _exists(self.spark, folder):
            return 0, None
        stamps = self.spark.read.schema("path string, length bigint, modified timestamp, content_md5 string, batch bigint").parquet(folder)
        newest = stamps.agg(F.max("batch")).first()[0] or 0
        return newest, stamps.where(F.col("batch") == newest).drop("batch") if newest else None

    def terms(self, at: Commit | None = None) -> DataFrame:
        """``field, term, df, ttf, lead_docs, max_tf, min_dl_q, bucket`` over live documents.

        The last two are bounds: documents that are gone may have set them.
        """
        at = at or self.commit()
        deltas = self._read("terms", "segment", at.segments)
        if len(at.segments) <= 1 and not at.n_dead:
            return deltas.drop("segment")
        return (
            deltas.groupBy("bucket", "field", "term")
            .agg(
                *[F.sum(c).alias(c) for c in ("df", "ttf", "lead_docs")],
                F.max("max_tf").alias("max_tf"),
                F.min("min_dl_q").alias("min_dl_q"),
            )
            .where("df > 0")
        )

    def field_stats(self, at: Commit | None = None) -> DataFrame:
        """``field, doc_count, sum_dl, avgdl``: one row per field."""
        at = at or self.commit()
        deltas = self._read("fields", "segment", at.segments)
        sums = deltas.groupBy("field").agg(*[F.sum(c).alias(c) for c in ("doc_count", "sum_dl")])
        return sums.where("doc_count > 0").withColumn("avgdl", F.col("sum_dl") / F.col("doc_count"))

    def changes(self, version: int) -> DataFrame:
        return self._read("changes", "version", [version]).drop("version")

    # -- writers ------------------------------------------------------------

    def _write(self, rows: DataFrame, table: str, part: str, number: int, by: str | None = None) -> None:
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(self._folder(table, part, number))

    def _write_grouped(
        self, rows: DataFrame, table: str, segment: int, by: str, order: Sequence[str]
    ) -> None:
        # REBALANCE gives files of about the advisory size: a large folder is
        # split over several tasks, small ones share a task.
        grouped = rows.hint("rebalance", F.col(by)).sortWithinPartitions(by, *order)
        self._write(grouped, table, "segment", segment, by)

    def remember(self, versions: DataFrame) -> None:
        """Add ``path, ts, hash`` to what feeds have brought."""
        versions.write.parquet(f"{self.root}/seen/batch={uuid.uuid4().hex}")

    def stamp(self, files: DataFrame, number: int) -> None:
        """Replace the stamps; rows of a write that failed only cost reading their files again."""
        files.write.mode("overwrite").parquet(f"{self.root}/stamps/batch={number}")

    def write_forward(self, documents: DataFrame, segment: int, at: Commit, paths: DataFrame) -> None:
        """Analyse documents and store them with their ids.

        A document without an id of its own gets a number from its path;
        ``paths`` are the paths of the documents, ``at`` the commit before.

        This is the only step that touches text.  All other tables are made
        from the stored result, so a lost executor costs a few file splits and
        the ids, once written, stay what they are.
        """
        if "doc_id" not in documents.columns:
            documents = self._numbered(documents, at, paths.select("path"))
        texts = [F.col(f).alias(f) for f in self.fields]
        corpus = documents.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            "path",
            F.col("title").alias("stored_title"),
            "content_md5",
            *texts,
        )
        analyzed = P.analyze_documents(corpus, self.fields).withColumnRenamed("stored_title", "title")
        self._write(analyzed, "forward", "segment", segment)

    def _numbered(self, documents: DataFrame, at: Commit, paths: DataFrame) -> DataFrame:
        """Documents with ``doc_id``, a 63-bit hash of the path.

        Of paths that share a number, the one that is in the index keeps it,
        else the first by name; the others take the hash of a next attempt
        until all differ.  Only paths and numbers are shuffled for that, and
        beyond the first attempt only those that met another.
        """
        known = self.docs(at).select("path", "doc_id").join(paths, "path", "left_anti") if at.segments else None
        given = paths.withColumn("doc_id", path_number(F.col("path"), 0))
        moved, attempt = [], 0
        while True:
            places = given.select("doc_id", F.struct(F.lit(1).alias("turn"), "path").alias("who"))
            if known is not None:
                places = places.unionByName(known.select("doc_id", F.struct(F.lit(0).alias("turn"), "path").alias("who")))
            shared = places.groupBy("doc_id").agg(F.min("who").alias("keeper"), F.count("*").alias("n")).where("n > 1")
            # A path that occurs twice is told by its own error, so it keeps its number here.
            losers = given.join(shared, "doc_id").where(F.col("path") != F.col("keeper.path")).select("path").distinct()
            names = losers.collect()  # about n * n / 2 ** 64 of n paths
            if not names:
                break
            attempt += 1
            losers = local_rows(self.spark, [r.asDict() for r in names], "path string")
            again = losers.withColumn("doc_id", path_number(F.col("path"), attempt))
            given = given.join(F.broadcast(losers), "path", "left_anti").unionByName(again)
            moved = [m for m in moved if m["path"] not in {r["path"] for r in names}]
            moved += [r.asDict() for r in again.collect()]
        if not moved:
            return documents.withColumn("doc_id", path_number(F.col("path"), 0))
        moved = local_rows(self.spark, moved, "path string, doc_id bigint")
        found = documents.join(F.broadcast(moved), "path", "left")
        return found.withColumn("doc_id", F.coalesce("doc_id", path_number(F.col("path"), 0)))

    def write_segment(self, segment: int, dead_forward: DataFrame | None) -> None:
        """Docs, postings and term statistics of a stored segment.

        ``dead_forward``: stored documents that this commit takes out; their
        share of the statistics is subtracted.
        """
        forward = self._read("forward", "segment", [segment]).drop("segment")
        docs = self.segment_documents(segment).withColumn("shard", self.shard(F.col("doc_id")))
        self._write_grouped(docs, "docs", segment, "shard", ["doc_id"])
        self._write_grouped(
            P.postings_of(forward, self.fields).withColumn("bucket", self.bucket(F.col("term"))),
            "postings",
            segment,
            "bucket",
            ["field", "term", "doc_id"],
        )
        terms = P.term_dictionary(self._read("postings", "segment", [segment]))
        if dead_forward is not None:
            gone = P.term_dictionary(P.postings_of(dead_forward, self.fields))
            negated = gone.select("field", "term", *[(-F.col(c)).alias(c) for c in ("df", "ttf", "lead_docs")])
            terms = terms.unionByName(negated, allowMissingColumns=True)
        self._write_grouped(
            terms.withColumn("bucket", self.bucket(F.col("term"))), "terms", segment, "bucket", ["field", "term"]
        )

        self._write(
            P.field_statistics(self._read("terms", "segment", [segment])).coalesce(1),
            "fields",
            "segment",
            segment,
        )

    def copy_forward(self, at: Commit, segment: int) -> None:
        """Live stored documents into a segment of their own."""
        self._write(self.forward(at).drop("segment"), "forward", "segment", segment)

    def write_changes(self, events: DataFrame, version: int) -> None:
        self._write(events, "changes", "version", version)

    def write_dead(self, dead: DataFrame, version: int) -> None:
        self._write(dead.select("doc_id", "segment"), "dead", "version", version)

    def publish(self, commit: Commit) -> None:
        row = local_rows(
            self.spark,
            [
                {
                    "segments": list(commit.segments),
                    "n_dead": commit.n_dead,
                    "fields": list(self.fields),
                    "buckets": self.buckets,
                    "shards": self.shards,
                }
            ],
            "segments array<int>, n_dead bigint, fields array<string>, buckets int, shards int",
        )
        self._write(row, "commits", "version", commit.version)


def local_rows(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A handful of driver rows as a local relation, whose size Spark knows."""
    types = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), to_arrow_schema(types)), types)


def folders_for(spark: SparkSession, source: str, folder_bytes: int = 1 << 29) -> int:
    """A number of index folders for a source of this size, 16 at least.

    One per half gigabyte of input, up to 4096: beyond that the folders get
    more files each instead of becoming more.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(source)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return min(4096, max(16, files.getContentSummary(path).getLength() // folder_bytes))


def _exists(spark: SparkSession, folder: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def path_number(path: Column, attempt: int) -> Column:
    """A number of 63 bits for a path; another one for each attempt."""
    return F.xxhash64(path, F.lit(attempt)).bitwiseAND(F.lit((1 << 63) - 1))
