"""The point store, the index state and the quarantine table.

A store is a folder on shared storage:

* ``points/v=<n>/`` Parquet, one folder a write, partitioned by ``bucket =
                  pmod(xxhash64(file_hash), buckets)``: all points of one
                  content share a bucket (ids derive from the content hash);
                  rows sorted by (file_type, filename, page) inside each file,
                  with Bloom filters of the declared columns, so filters on
                  those payload fields skip row groups (S4).
* ``state/v=<n>/``  Parquet ``(path, file_hash)`` (S8).
* ``seen/v=<n>/``   Parquet ``(path, length, modified, file_hash)`` of files read.
* ``manifest/``     small JSON files, the highest number counts: which buckets
                  are read from which write, and which state holds.
* ``quarantine/``   Parquet, appended (S10).

A write puts its files into a folder of its own and becomes visible by one
new manifest, so readers never see half of it and a crash leaves the old
contents.  An upsert looks only into the buckets that its points fall into and
rewrites only those in which it replaces an id; into the others it just adds.
Ids are deterministic, so running again after a failure gives the same rows.
The number of buckets is fixed when the store is made.  No table format is
required; one writer at a time (a second one fails at its manifest).
"""

from __future__ import annotations

import json
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.text import file_name, file_stem, file_suffix
from vellum.operators.dedup import last_wins, last_wins_by_keys
from vellum.session import scratch_path

DEFAULT_BUCKETS = 64
# Payload fields that the store is asked to filter by.
FILTER_COLUMNS = ("filename", "file_hash", "page", "indexed_at")

# Fields of a G2 point besides id and vector (payload).
POINT_FIELDS = [
    ("filename", T.StringType()),
    ("filepath", T.StringType()),
    ("file_type", T.StringType()),
    ("file_hash", T.StringType()),
    ("chunk_id", T.IntegerType()),
    ("char_count", T.IntegerType()),
    ("indexed_at", T.StringType()),
    ("page", T.IntegerType()),
    ("total_pages", T.IntegerType()),
    ("section", T.StringType()),
    ("section_idx", T.IntegerType()),
    ("total_chunks", T.IntegerType()),
    ("text", T.StringType()),
]


def point_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("point_id", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType()))]
        + [T.StructField(n, t) for n, t in POINT_FIELDS]
    )


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


class VectorStore:
    """A named collection of points with one vector size, cosine distance."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS, files_per_bucket: int = 2):
        self.spark, self.root = spark, root.rstrip("/")
        self._new_buckets, self._meta = buckets, None
        self.files_per_bucket = files_per_bucket
        self.points_path = f"{self.root}/points"
        self.state_path = f"{self.root}/state"
        self.seen_path = f"{self.root}/seen"
        self.quarantine_path = f"{self.root}/quarantine"
        self.meta_path = f"{self.root}/meta"
        self.manifest_path = f"{self.root}/manifest"

    # ------------------------------------------------------------ S3
    def ensure(self, dim: int, schema: T.StructType | None = None, more: dict | None = None) -> "VectorStore":
        """Create the collection if absent (vector size and number of buckets
        are fixed here); an existing one is left untouched, and of several first
        writers one makes it: the folder appears by one rename."""
        if _exists(self.spark, self.meta_path):
            return self
        meta = {"dim": dim, "distance": "cosine", "buckets": self._new_buckets, "schema": (schema or point_schema()).json()} | (more or {})
        part = f"{self.root}/.meta-{uuid.uuid4().hex[:12]}"
        self.spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(part)
        fs, final = _fs(self.spark, self.meta_path)
        # renamed onto a folder that is there by now, it would go inside that one
        if not fs.exists(final):
            fs.rename(_fs(self.spark, part)[1], final)
        delete_path(self.spark, part)
        delete_path(self.spark, f"{self.meta_path}/{part.rsplit('/', 1)[1]}")
        return self

    def meta(self) -> dict:
        if self._meta is None:
            self._meta = json.loads(self.spark.read.text(self.meta_path).first()[0])
        return self._meta

    @property
    def buckets(self) -> int:
        """As the store was made, whatever this object was given."""
        return int(self.meta()["buckets"]) if _exists(self.spark, self.meta_path) else self._new_buckets

    @property
    def dim(self) -> int:
        return int(self.meta()["dim"])

    def _schema(self) -> T.StructType:
        base = T.StructType.fromJson(json.loads(self.meta()["schema"]))
        return base.add("bucket", T.IntegerType())

    # ------------------------------------------------------------ snapshots
    def _names(self, folder: str) -> list[str]:
        fs, p = _fs(self.spark, folder)
        return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []

    def manifest(self) -> dict:
        """``n``, ``points`` (write -> its buckets that count) and ``state``."""
        found = [f for f in self._names(self.manifest_path) if f.endswith(".json")]
        if not found:
            return {"n": 0, "points": {}, "state": None}
        return self._get(f"{self.manifest_path}/{max(found)}")

    def _publish(self, manifest: dict) -> None:
        n = manifest["n"] + 1
        fs, part = _fs(self.spark, f"{self.manifest_path}/{n:012d}.part")
        self._put(f"{self.manifest_path}/{n:012d}.part", manifest | {"n": n})
        _, final = _fs(self.spark, f"{self.manifest_path}/{n:012d}.json")
        if fs.exists(final) or not fs.rename(part, final):
            raise RuntimeError(f"the store was changed by another writer (manifest {n})")

    # ------------------------------------------------------------ S4
    def declare_filter_columns(self, columns: tuple[str, ...] = FILTER_COLUMNS, partition: str | None = None, row_group_bytes: int | None = None) -> "VectorStore":
        """Payload columns that searches and scans filter by.

        Files written from now on carry a Bloom filter of each (beside the minima,
        maxima and page indexes that Parquet keeps anyway), so Spark's reader leaves
        out row groups without the value; ``row_group_bytes`` makes them smaller.
        ``partition`` (of few values, as file_type) becomes a folder below the
        bucket and can be declared before the first write only."""
        names = set(self._schema().fieldNames()) - {"bucket", "vector"}
        if unknown := (set(columns) | ({partition} if partition else set())) - names:
            raise ValueError(f"not a payload column: {sorted(unknown)}")
        if partition != self.filters().get("partition") and self.manifest()["points"]:
            raise ValueError("the partition column is fixed by the first write")
        said = {"columns": list(columns), "partition": partition, "row_group_bytes": row_group_bytes}
        self._put(f"{self.root}/filters", said)
        return self

    def filters(self) -> dict:
        path = f"{self.root}/filters"
        return self._get(path) if _exists(self.spark, path) else {"columns": [], "partition": None, "row_group_bytes": None}

    def _get(self, path: str) -> dict:
        fs, p = _fs(self.spark, path)
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, path: str, value: dict) -> None:
        fs, p = _fs(self.spark, path)
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()

    def _write(self, rows: DataFrame, replaced: list[int]) -> None:
        """``rows`` become a new write; the buckets ``replaced`` are read from
        it alone."""
        m, filters = self.manifest(), self.filters()
        version = uuid.uuid4().hex[:12]
        folder = f"{self.points_path}/v={version}"
        layout = self._layout(rows.select(*self._schema().fieldNames()))
        writer = layout.write.partitionBy("bucket", *([filters["partition"]] if filters["partition"] else []))
        for c in filters["columns"]:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        if filters["row_group_bytes"]:
            writer = writer.option("parquet.block.size", str(filters["row_group_bytes"]))
        writer.parquet(folder)
        written = sorted(int(f.split("=")[1]) for f in self._names(folder) if f.startswith("bucket="))
        points = {v: [b for b in bs if b not in replaced] for v, bs in m["points"].items()}
        self._publish(m | {"points": {v: bs for v, bs in points.items() if bs} | ({version: written} if written else {})})

    def vacuum(self) -> None:
        """Delete writes and states that the current manifest doesn't name."""
        m = self.manifest()
        live = {f"bucket={b}@{v}" for v, bs in m["points"].items() for b in bs}
        for v in self._names(self.points_path):
            for b in self._names(f"{self.points_path}/{v}"):
                if b.startswith("bucket=") and f"{b}@{v.split('=')[1]}" not in live:
                    delete_path(self.spark, f"{self.points_path}/{v}/{b}")
        for v in self._names(self.state_path):
            if v != f"v={m['state']}":
                delete_path(self.spark, f"{self.state_path}/{v}")
        for v in self._names(self.seen_path):
            if v != f"v={m.get('seen')}":
                delete_path(self.spark, f"{self.seen_path}/{v}")

    def _read(self, buckets: list[int] | None = None) -> DataFrame:
        """The points, of all or of some buckets (others' files are not listed)."""
        paths = [f"{self.points_path}/v={v}/bucket={b}" for v, bs in self.manifest()["points"].items()
                 for b in bs if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).option("basePath", self.points_path).parquet(*paths).select(*self._schema().fieldNames())

    # ------------------------------------------------------------ S5 / S11
    def scan(self, columns: list[str] | None = None) -> DataFrame:
        """All points (file splits replace paginated scrolling); pruned to ``columns``."""
        df = self._read()
        return df.select(*columns) if columns else df.drop("bucket")

    def count(self) -> int:
        return self._read().count()

    # ------------------------------------------------------------ S4 + S6
    def bucket_of(self, file_hash):
        return F.pmod(F.xxhash64(file_hash), F.lit(self.buckets)).cast("int")

    moves = False  # an id stays in its bucket

    def _place(self, points: DataFrame) -> DataFrame:
        return points.withColumn("bucket", self.bucket_of(F.col("file_hash")))

    def _checked(self, points: DataFrame) -> DataFrame:
        dim = self.dim
        bad = F.size("vector") != F.lit(dim)
        return points.withColumn(
            "vector",
            F.when(bad, F.raise_error(F.concat(F.lit(f"vector size must be {dim}, got "), F.size("vector").cast("string"))))
            .otherwise(F.col("vector")),
        )

    def _layout(self, df: DataFrame) -> DataFrame:
        """One writer per (bucket, salt): a bucket is spread over
        ``files_per_bucket`` tasks, never gathered into one."""
        order = [c for c in ("file_type", "filename", "page") if c in df.columns]
        salt = F.pmod(F.xxhash64("point_id"), F.lit(self.files_per_bucket))
        return df.repartition(F.col("bucket"), salt).sortWithinPartitions("bucket", *order)

    def upsert(self, points: DataFrame, dedup: bool = True) -> None:
        """Insert or replace by ``point_id`` (last path wins inside the batch).

        The batch is written once as it comes; what to drop of it, and of the old
        points, is decided on ids alone.  Texts and vectors are shuffled once, to
        their buckets, while the ids with several rows and the replaced ids are few
        enough to be broadcast (Spark's own limit); beyond that they are joined too."""
        names = self._schema().fieldNames()
        batch, hits = scratch_path(self.spark, "upsert"), scratch_path(self.spark, "replaced")
        self._place(self._checked(points)).select(*names).write.parquet(batch)
        new = self.spark.read.schema(self._schema()).parquet(batch)
        touched = None if self.moves else [r[0] for r in new.select("bucket").distinct().collect()]  # at most `buckets` numbers
        old = self._read(touched)
        old.select("point_id", "bucket").join(new.select("point_id"), "point_id", "left_semi").write.parquet(hits)
        found = self.spark.read.schema(self._schema()).parquet(hits).select("point_id", "bucket")
        replaced = [r[0] for r in found.select("bucket").distinct().collect()]
        keep = self._read(replaced).join(found.select("point_id"), "point_id", "left_anti")
        fresh = last_wins_by_keys(new) if dedup else new
        self._write(keep.select(*names).unionByName(fresh.select(*names)), replaced)
        delete_path(self.spark, batch)
        delete_path(self.spark, hits)

    def remove_stale(self, state: DataFrame) -> None:
        """D8 clean-up: drop points whose (filepath, file_hash) is not the
        current state of that path.  Only the buckets holding such points are
        rewritten."""
        from vellum.operators.dedup import stale_points

        stage = scratch_path(self.spark, "clean")
        stale_points(self._read().select("point_id", "filepath", "file_hash", "bucket"), state).select("point_id", "bucket").write.parquet(stage)
        stale = self.spark.read.schema(self._schema()).parquet(stage).select("point_id", "bucket")
        touched = [r[0] for r in stale.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if touched:
            self._write(self._read(touched).join(stale.select("point_id"), "point_id", "left_anti"), touched)
        delete_path(self.spark, stage)

    # ------------------------------------------------------------ S7
    def append(self, points: DataFrame) -> None:
        """S7 (G1): every row gets a fresh random UUID, so nothing is replaced."""
        rows = self._checked(points).withColumn("point_id", F.expr("uuid()"))
        self._write(self._place(rows), [])

    # ------------------------------------------------------------ S8
    def load_state(self) -> DataFrame:
        """Index state ``(path, file_hash)``; missing or unreadable (its files
        are read through once) -> empty."""
        version = self.manifest()["state"]
        if version is not None:
            try:
                state = self.spark.read.schema("path string, file_hash string").parquet(f"{self.state_path}/v={version}")
                state.write.format("noop").mode("overwrite").save()
                return state
            except Exception as e:  # noqa: BLE001 - unreadable state means start from scratch
                warnings.warn(f"index state is unreadable, starting without: {e}", stacklevel=2)
        return self.spark.createDataFrame([], "path string, file_hash string")

    def save_state(self, state: DataFrame, seen: DataFrame | None = None) -> None:
        """The state (and what was ``seen``) becomes a new folder, then the
        manifest names it."""
        version = uuid.uuid4().hex[:12]
        state.select("path", "file_hash").write.parquet(f"{self.state_path}/v={version}")
        names = {"state": version}
        if seen is not None:
            seen.select("path", "length", "modified", "file_hash").write.parquet(f"{self.seen_path}/v={version}")
            names["seen"] = version
        self._publish(self.manifest() | names)

    def load_seen(self) -> DataFrame:
        """Length and time of change of every file when it was last read with
        success, and its hash; empty before the first run over a folder."""
        version, schema = self.manifest().get("seen"), "path string, length long, modified timestamp, file_hash string"
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.seen_path}/v={version}")

    # ------------------------------------------------------------ S10
    def quarantine(self, failed: DataFrame, failed_at: str | None = None) -> None:
        """Append failed files with their error and quarantine name; a file that
        is there with the same error already (a run repeated) is not added."""
        before = self.load_quarantine().select(F.col("path").alias("p"), F.col("error").alias("e"))
        new = failed.select("path", "error").distinct().join(before, F.col("path").eqNullSafe(F.col("p")) & F.col("error").eqNullSafe(F.col("e")), "left_anti")
        quarantine_rows(new, failed_at).write.mode("append").parquet(self.quarantine_path)

    def load_quarantine(self) -> DataFrame:
        schema = "path string, filename string, error string, failed_at timestamp, quarantine_name string"
        if _exists(self.spark, self.quarantine_path):
            return self.spark.read.schema(schema).parquet(self.quarantine_path)
        return self.spark.createDataFrame([], schema)


def quarantine_rows(failed: DataFrame, failed_at: str | None = None) -> DataFrame:
    """``path, filename, error, failed_at, quarantine_name`` where the name
    is ``<stem>__<yyyyMMdd_HHmmss><suffix>``."""
    ts = F.to_timestamp(F.lit(failed_at)) if failed_at else F.current_timestamp()
    return failed.select(
        "path",
        file_name("path").alias("filename"),
        F.col("error"),
        ts.alias("failed_at"),
        F.concat(file_stem("path"), F.lit("__"), F.date_format(ts, "yyyyMMdd_HHmmss"), file_suffix("path")).alias(
            "quarantine_name"
        ),
    )


def upsert_merge(old: DataFrame, new: DataFrame, key: str = "point_id", order: str = "filepath") -> DataFrame:
    """S6 as a pure DataFrame: ``old`` minus replaced ids, plus ``new`` (last
    path wins among new rows with one id)."""
    fresh = last_wins(new, key, order)
    return old.join(fresh.select(key), key, "left_anti").unionByName(fresh)
