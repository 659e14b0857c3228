"""Session helpers: durable intermediates, table access, parallelism of small inputs."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: set[str] = set()
_STEPS: list[list[str]] = []
#: Rows of one Arrow batch; long texts make larger batches a memory risk for Python workers.
BATCH_ROWS = 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Where it is unset a temporary one is made, but only in local mode: executors on other machines couldn't read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's own part of the shared folder, which goes when the driver ends."""
    root = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_forget, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _forget(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone before
        drop_path(spark, root)


def durable_path(df: DataFrame, name: str, lasting: bool = False) -> str:
    """Write df to a fresh path of the shared folder. lasting: it outlives the step it is made in."""
    path = scratch(df.sparkSession, name)
    if _STEPS and not lasting:
        _STEPS[-1].append(path)
    df.write.parquet(path)
    return path


def durable(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor loses nothing."""
    return df.sparkSession.read.schema(df.schema).parquet(durable_path(df, name, lasting))


@contextlib.contextmanager
def step(spark: SparkSession):
    """One turn of a driver's loop: at its end the tables made durable in it go, but for lasting ones, and so do the
    shuffle files and plans that nothing refers to any more; they would pile up until the loop ends."""
    _STEPS.append([])
    try:
        yield
    finally:
        for path in _STEPS.pop():
            drop_path(spark, path)
        gc.collect()  # Python's handles on the JVM's objects first
        spark.sparkContext._jvm.System.gc()


def _fs(spark: SparkSession, path: str):
    """(client, path) of the file system a path lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def on_mount(spark: SparkSession, path: str) -> bool:
    """Whether a path lies in a mounted folder, which Python workers can open as Spark's own tasks do."""
    return _fs(spark, path)[0].getUri().getScheme() == "file"


def stream_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any file system, read by the driver's client in chunks."""
    fs, target = _fs(spark, path)
    source = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(source)
    finally:
        source.close()


def make_path(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a path, atomically where the file system can."""
    fs, source = _fs(spark, path)
    fs.rename(source, _fs(spark, to)[1])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there: written beside its place and renamed."""
    fs, part = _fs(spark, f"{path}.part")
    fs.setWriteChecksum(False)
    out = fs.create(part, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    target = _fs(spark, path)[1]
    fs.delete(target, False)
    fs.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or null where there is none."""
    if not path_exists(spark, path):
        return None
    fs, target = _fs(spark, path)
    fs.setVerifyChecksum(False)
    source = fs.open(target)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none where there is no folder."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path below the shared folder through the cluster's own file system client."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Logical operators that neither shuffle nor hold more than a row.
_LOCAL = {"Project", "Filter", "Union", "LogicalRelation", "LocalRelation", "LogicalRDD", "Generate", "SubqueryAlias"}


def _nodes(plan) -> list[str]:
    """Names of the operators of a logical plan."""
    below = plan.children()
    return [plan.nodeName().split(" ")[0], *(x for i in range(below.size()) for x in _nodes(below.apply(i)))]


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Give a CPU-heavy stage at least one task per core when the scan yields fewer.

    Large inputs already have many splits and are returned untouched, so no shuffle is added at scale. Plans that do
    more than scan, filter and project are returned untouched too: counting their partitions could run them.
    """
    spark = df.sparkSession
    if cols:
        df = df.select(*cols)
    if not _LOCAL.issuperset(_nodes(df._jdf.queryExecution().optimizedPlan())):
        return df
    cores = max(2, spark.sparkContext.defaultParallelism)
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def hash_sample(df: DataFrame, key: str, limit: int, total: int | None = None, slack: float = 4) -> DataFrame:
    """At most `limit` rows, the first in the order of a hash of their key: the same rows however df is partitioned.

    total: rows of the table that df filters, known from its files' footers; without it df is counted. Only rows below a hash bound that keeps
    `slack` times the limit of that table take part in the sort, so the tasks together send the driver a small multiple
    of the sample, whatever the size of df; fewer rows than the limit come out where a filter keeps under 1 / slack.
    """
    h = F.xxhash64(key)
    total = df.count() if total is None else total
    if total > slack * limit:
        df = df.filter(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, (slack * limit + 100) / total)))
    return df.orderBy(F.pmod(h, F.lit(1 << 30)), key).limit(limit)


def ship(spark: SparkSession) -> SparkSession:
    """Prepare a session: the package importable in its Python workers, wherever they run, and small Arrow batches."""
    import shutil
    from pathlib import Path

    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(sc, "_tidemark_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    into = tempfile.mkdtemp(prefix="tidemark-ship-")  # read by the driver alone; Spark's file server hands it out
    atexit.register(shutil.rmtree, into, ignore_errors=True)
    clean = Path(into) / "src" / root.name
    shutil.copytree(root, clean, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{into}/{root.name}_src", "zip", clean.parent))
    sc._tidemark_shipped = True
    return spark
