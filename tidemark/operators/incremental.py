"""Processing only new or changed records (problem 5).

`Manifest` keeps, in a folder of the shared file system, one row per processed unit of input: its name, size and
checksum. A run lists the inputs, anti-joins the listing with the manifest, writes the result under the batch's own
identifier (a rerun overwrites just that folder) and only then commits the batch's rows to the manifest. Readers see
committed batches only, so a run that broke off neither skips nor repeats anything.

`compared` is the record-level part: of the listed runs that are due it marks those records that are new or
changed against the state saved so far and what committed batches gave since, run by run, without iterating over the
runs. `ingest` puts both together: the units are the listing's files, and only new or changed files are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import make_path, move_path, on_mount, path_exists, scratch, stream_hash

UNIT_SCHEMA = "unit string, size long, checksum string"
RECORDS = "rodada string, id_na_fonte string, hash_texto string, mudou boolean"
#: Bytes up to which a file is hashed as one row; larger ones are hashed as streams, with the same result.
CONTENT_LIMIT = 1 << 28


def list_files(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(unit, size, checksum) of the files below path.

    The checksum is the SHA-256 of the bytes, whatever their number. Files above CONTENT_LIMIT are read in chunks: by the
    tasks, one for each file, where its address is `file:`, and else one after the other by the driver's client, as
    Python workers have none for other file systems.
    limit: only where a caller names one, files above it aren't read, and the time of their last change stands for the
    checksum; a change that keeps size and time isn't seen then.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name, size = F.col("path").alias("unit"), F.col("length").alias("size")
    whole = files if limit is None else files.filter(F.col("length") <= limit)
    small = whole.filter(F.col("length") <= CONTENT_LIMIT).select(name, size, F.sha2("content", 256).alias("checksum"))
    large = whole.filter(F.col("length") > CONTENT_LIMIT).select(name, size)
    if on_mount(spark, path):
        found = small.unionByName(large.mapInArrow(_hashed, UNIT_SCHEMA))
    else:
        found = small.unionByName(spark.createDataFrame([(r["unit"], r["size"], stream_hash(spark, r["unit"])) for r in large.collect()], UNIT_SCHEMA))
    if limit is None:
        return found
    return found.unionByName(files.filter(F.col("length") > limit).select(name, size, F.col("modificationTime").cast("string").alias("checksum")))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the SHA-256 of the files (unit, size) names by `file:` addresses, each read in chunks."""
    for b in batches:
        sums = []
        for unit in b.column("unit").to_pylist():
            with open(unit.removeprefix("file:"), "rb") as f:
                sums.append(hashlib.file_digest(f, "sha256").hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("unit"), b.column("size"), pa.array(sums, pa.string())], names=["unit", "size", "checksum"])


class Manifest:
    """Processed inputs and the batches made from them, below `root` in a file system all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def committed(self) -> DataFrame:
        """(unit, size, checksum, batch) of all inputs of committed batches; empty before the first."""
        if not path_exists(self.spark, f"{self.root}/manifest"):
            return self.spark.createDataFrame([], UNIT_SCHEMA + ", batch string")
        return self.spark.read.schema(UNIT_SCHEMA + ", batch string").option("recursiveFileLookup", "true").parquet(f"{self.root}/manifest")

    def pending(self, listing: DataFrame) -> DataFrame:
        """Inputs that no committed batch holds with the same size and checksum; null sizes and checksums compare equal."""
        done = self.committed()
        same = (listing.unit == done.unit) & listing["size"].eqNullSafe(done["size"]) & listing.checksum.eqNullSafe(done.checksum)
        return listing.join(done, same, "left_anti").dropDuplicates(["unit"])

    def batch_id(self, units: DataFrame) -> str | None:
        """A name that depends on the batch's inputs alone (order-free sums of their hashes), so a rerun has the same one."""
        r = units.agg(F.count("*").alias("n"), F.sum(F.xxhash64("unit", "size", "checksum").cast("decimal(38,0)")).alias("h")).first()
        return hashlib.sha256(f"{r.n}:{r.h}".encode()).hexdigest()[:16] if r.n else None

    def run(self, listing: DataFrame, process: Callable[[DataFrame], DataFrame]) -> str | None:
        """Process what is pending as one batch and commit it; None when there is nothing to do."""
        units = self.pending(listing)
        staged = f"{self.root}/staged/{hashlib.sha256(self.root.encode()).hexdigest()[:8]}"
        units.write.mode("overwrite").parquet(staged)  # the batch is fixed here: later arrivals wait for the next run
        units = self.spark.read.schema(UNIT_SCHEMA).parquet(staged)
        batch = self.batch_id(units)
        if batch is None:
            return None
        process(units).write.mode("overwrite").parquet(f"{self.root}/data/batch={batch}")
        self.commit(units, batch)
        return batch

    def commit(self, units: DataFrame, batch: str) -> None:
        """Publish the batch by one rename; a manifest folder that isn't complete is never visible."""
        temp, final = f"{self.root}/commit/{batch}", f"{self.root}/manifest/{batch}"
        units.select("unit", "size", "checksum", F.lit(batch).alias("batch")).write.mode("overwrite").parquet(temp)
        if not path_exists(self.spark, final):
            make_path(self.spark, f"{self.root}/manifest")
            move_path(self.spark, temp, final)

    def read(self, schema: str) -> DataFrame:
        """Rows of committed batches, by a semi-join with the manifest; an uncommitted batch's folder doesn't count."""
        if not path_exists(self.spark, f"{self.root}/data"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch string").option("basePath", f"{self.root}/data").parquet(f"{self.root}/data")
        return rows.join(self.committed().select("batch").distinct(), "batch", "left_semi").drop("batch")


def current_versions(listing: DataFrame) -> DataFrame:
    """The row with the latest atualizado_em of each (rodada, id_na_fonte); of equal times the greatest ord, nulls last."""
    order = F.struct(F.col("atualizado_em").isNotNull(), "atualizado_em", "ord")
    known = listing.filter(F.col("rodada").isNotNull() & F.col("id_na_fonte").isNotNull())
    return known.groupBy("rodada", "id_na_fonte").agg(F.max_by("hash_texto", order).alias("hash_texto"))


def saved_state(saves: DataFrame) -> DataFrame:
    """(id_na_fonte, saved_hash, saved_run) over all saves; of several entries of one id the greatest gravacao holds."""
    entries = saves.select("gravacao", "rodada", F.explode("vistos").alias("id_na_fonte", "h"))
    last = entries.groupBy("id_na_fonte").agg(F.max_by(F.struct("h", "rodada"), "gravacao").alias("_l"))
    return last.select("id_na_fonte", F.col("_l.h").alias("saved_hash"), F.col("_l.rodada").alias("saved_run"))


def compared(due: DataFrame, saves: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """(rodada, id_na_fonte, hash_texto, mudou) of the records of due runs; mudou: new, or other than the last processed version.

    After a due run the version last processed is that run's current one, case or not, so the comparison is with the
    row before in the id's own order of runs, or with the saved state for the first; a window replaces the loop.
    A null hash is a version of its own: it equals another null and differs from every other hash. Rows without run
    or id can't be told apart and are left out. An id never saved is new whatever its hash. Copies of a hot id fold
    in the map-side aggregate of `current_versions`, so a window holds at most one row per due run and one per version.

    done: what this function gave for earlier batches, unchanged ones too. These rows stand in their run's place in the order, before a due
    row of the same run that was listed anew, and don't come out again; those of a run up to the id's own save are
    superseded by it.
    """
    now = current_versions(due).withColumn("_done", F.lit(False))
    state = saved_state(saves).withColumn("_saved", F.lit(True))
    if done is not None:
        known = done.select("rodada", "id_na_fonte", "hash_texto").distinct()
        later = known.join(state, "id_na_fonte", "left").filter(F.col("saved_run").isNull() | (F.col("rodada") > F.col("saved_run")))
        again = (now.rodada == known.rodada) & (now.id_na_fonte == known.id_na_fonte) & now.hash_texto.eqNullSafe(known.hash_texto)
        now = now.join(known, again, "left_anti").unionByName(later.select("rodada", "id_na_fonte", "hash_texto", F.lit(True).alias("_done")))
    w = Window.partitionBy("id_na_fonte").orderBy("rodada", F.desc("_done"))
    first = F.row_number().over(w) == 1
    prev = now.withColumn("_first", first).withColumn("_prev", F.lag("hash_texto").over(w))
    j = prev.filter(~F.col("_done")).join(state, "id_na_fonte", "left")
    same_as_saved = F.coalesce("_saved", F.lit(False)) & F.col("hash_texto").eqNullSafe(F.col("saved_hash"))
    changed = F.when(F.col("_first"), ~same_as_saved).otherwise(~F.col("hash_texto").eqNullSafe(F.col("_prev")))
    return j.select("rodada", "id_na_fonte", "hash_texto", changed.alias("mudou"))


def changed_records(due: DataFrame, saves: DataFrame) -> DataFrame:
    """(rodada, id_na_fonte, hash_texto) of the new or changed records of due runs, without a manifest."""
    return compared(due, saves).filter("mudou").drop("mudou")


def ingest(spark: SparkSession, path: str, saves: DataFrame, root: str | None = None) -> DataFrame:
    """(rodada, id_na_fonte, hash_texto) of all new or changed records that the listing's files below path gave so far.

    Files that the manifest below root holds with the same size and checksum aren't read. Those that are new or changed
    form one committed batch: the records of their due runs, compared with the saves and with earlier batches. Unchanged
    records are kept too, so that one listed anew is known to have been processed.
    root: None takes a fresh manifest that goes with the session.
    """
    manifest = Manifest(spark, root or scratch(spark, "manifest"))
    saved = saves.filter(F.col("rodada").isNotNull()).select("rodada").distinct()

    def process(units: DataFrame) -> DataFrame:
        listing = spark.read.parquet(*(r.unit for r in units.select("unit").collect()))  # one row per file of the batch
        return compared(listing.join(saved, "rodada", "left_anti"), saves, manifest.read(RECORDS))

    manifest.run(list_files(spark, path), process)
    return manifest.read(RECORDS).filter("mudou").drop("mudou")
