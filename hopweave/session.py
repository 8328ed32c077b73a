"""Sessions, and scratch tables that cut lineage.

Scratch tables live in the folder named by ``spark.checkpoint.dir``, which every
executor shares.  A lost executor therefore loses nothing: a later stage reads
the files again.  Only where that setting is absent and the master is local is a
temporary folder of this machine used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def local_session(cpus: int = 8, app: str = "hopweave", memory: str = "12g") -> SparkSession:
    """A ``local[cpus]`` session for tests and benchmarks, with a scratch folder of its own that goes with the process."""
    folder = tempfile.mkdtemp(prefix="hopweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.checkpoint.dir", f"file://{folder}")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for scratch tables that all executors can read."""
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="hopweave-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return f"file://{_local_dir}"


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of every executor, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_hopweave_shipped", None) != sc.applicationId:
        package = Path(__file__).resolve().parent
        folder = Path(tempfile.mkdtemp(prefix="hopweave-code-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(folder / "hopweave.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, Path(package.name) / p.relative_to(package))
        sc.addPyFile(str(folder / "hopweave.zip"))
        sc._hopweave_shipped = sc.applicationId
    return spark


#: Folders of scratch tables of this process, by application.
_roots: dict[str, tuple[SparkSession, set[str]]] = {}


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of the application. Results that read them must have been used or written before."""
    _, roots = _roots.pop(spark.sparkContext.applicationId, (spark, set()))
    for root in roots:
        _delete(spark, root)


class Scratch:
    """Numbered scratch tables of one job.

    ``cut(df)`` writes ``df`` and returns a scan of what was written; ``drop(path)``
    removes a table that nothing reads any more, so that an iteration holds two
    rounds on disk at most.  What is left stays until ``drop_scratch``, as results read it.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/hopweave/{spark.sparkContext.applicationId}/{job}-{uuid.uuid4().hex[:12]}"
        _roots.setdefault(spark.sparkContext.applicationId, (spark, set()))[1].add(self.root)
        self.made = 0

    def write(self, df: DataFrame) -> str:
        self.made += 1
        path = f"{self.root}/{self.made:04d}"
        df.write.parquet(path)
        return path

    def cut(self, df: DataFrame) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.write(df))

    def drop(self, path: str) -> None:
        _delete(self.spark, path)
