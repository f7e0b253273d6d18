"""Session helpers.

Nothing here changes how a query is planned; it only builds a session for tests,
the bench and local runs, and finds the shared checkpoint folder.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "revlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on and the web UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("REVLENS_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that folder must be shared storage and is set by whoever runs the job;
    it is never replaced here. Only a local-mode session without one (tests, the bench)
    gets a fresh folder of its own under the system temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder all executors share")
    local = tempfile.mkdtemp(prefix="revlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once an application, so that they need no
    installed copy of it."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        top, name = os.path.split(package)
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="revlens-"), name), "zip", top, name))
        _SHIPPED.add(sc.applicationId)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if it is a plain scan of fewer partitions than the cluster has
    cores (a small table in one file); larger scans stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Run:
    """Owner of the tables that ``materialize`` writes while it is open, one folder for each step:

        with Run(spark, "train-2024-05"):
            experiment(...).write.parquet(...)

    Consume lazy results before the run closes: at its end the tables are dropped. A run without a
    name drops them when it fails, too. One with a name keeps them when it fails or its driver
    dies, and the next run of that name, in this application or another, takes up the steps that
    were finished and goes on with the first that was not; from there on every step is written anew.
    Steps are told apart by their order, name and columns, so a name stands for one piece of work on
    one state of its inputs: give changed inputs another name. Two runs of one name must not be
    open at the same time.
    """

    def __init__(self, spark: SparkSession, name: str | None = None):
        if name is not None and not re.fullmatch(r"[\w.-]+", name):
            raise ValueError(f"a run's name has letters, digits, '_', '.' and '-' only: {name!r}")
        # the context's own folder carries the application in its name; runs lie beside it
        shared = ensure_checkpoint_dir(spark).rstrip("/").rpartition("/")[0]
        self.spark, self.named = spark, name is not None
        self.folder = f"{shared}/revlens-run-{name or uuid.uuid4().hex}"
        self._step, self._taking_up = 0, self.named

    def __enter__(self) -> Run:
        self._outer = _OPEN.set(self)
        return self

    def __exit__(self, failure, *_) -> None:
        _OPEN.reset(self._outer)
        if failure is None or not self.named:
            self.drop()

    def drop(self) -> None:
        """Delete the run's tables."""
        _delete(self.spark, self.folder)

    def manifest(self) -> list[tuple[str, str, bool]]:
        """(step, path, whether it was written to its end) of every table there is, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        steps = sorted(s.getPath().getName() for s in files.listStatus(path))
        return [(s, f"{self.folder}/{s}", self._complete(f"{self.folder}/{s}")) for s in steps]

    def _complete(self, path: str) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def _written(self, df: DataFrame, name: str) -> str:
        """The path of the next step's table, written now if no earlier run has finished it."""
        path = f"{self.folder}/{self._step:05d}-{name}"
        self._step += 1
        self._taking_up = self._taking_up and self._complete(path) and (
            df.sparkSession.read.parquet(path).schema.simpleString() == df.schema.simpleString())
        if not self._taking_up:
            df.write.mode("overwrite").parquet(path)
        return path


_OPEN: ContextVar[Run | None] = ContextVar("revlens_run", default=None)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    A written table instead of an RDD checkpoint: readable by any later session, the lineage
    is cut, and the files survive lost executors. The folder is the one
    ``spark.checkpoint.dir`` names. Inside a ``Run`` the table is the run's; else it stays until
    ``drop_table`` or whoever clears that folder.
    """
    spark, run = df.sparkSession, _OPEN.get()
    if run is not None:
        return spark.read.schema(df.schema).parquet(run._written(df, name))
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/revlens-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _folders(df: DataFrame) -> set[str]:
    return {f.rpartition("/")[0] for f in df.inputFiles()}


def reopen(df: DataFrame, spark: SparkSession) -> DataFrame:
    """The table that ``materialize`` wrote, read in another session of the application."""
    return spark.read.schema(df.schema).parquet(*sorted(_folders(df)))


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more. A named run keeps
    it to its end: a rerun may need it."""
    run = _OPEN.get()
    if run is not None and run.named:
        return
    for folder in _folders(df):
        if "/revlens-" in folder:
            _delete(df.sparkSession, folder)
