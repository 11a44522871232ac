"""Session helpers: local sessions for tests, UTC, scratch folders, scoped settings."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "millrace", **conf: str) -> SparkSession:
    """A session for tests and local benchmarks; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Wide generated records: many small methods, which the JVM compiles, instead of one huge one.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Event time is UTC everywhere: window bounds must not move with the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster gets an error, since a
    machine-local folder is not visible to the other executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="millrace-")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(_local_scratch[app] + "/rdd")
    return _local_scratch[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used; the first writer creates it."""
    return f"{scratch_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def cut_lineage(spark: SparkSession, df):
    """Reliable checkpoint in the shared folder (never executor-local storage)."""
    scratch_root(spark)
    return df.checkpoint(eager=True)


def current_run(spark: SparkSession) -> str:
    """Id of the streaming query whose batch is being handled, ``direct`` outside of one.

    The id lives in the query's checkpoint: a restart goes on with its run, a new query is a new run.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]):
    """Apply session settings for a block and put the old values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Folder:
    """Thin view of a path through the Hadoop file system, local or remote."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.path = self._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def children(self) -> list:
        return list(self.fs.listStatus(self.path)) if self.exists() else []

    def names(self) -> list[str]:
        return [status.getPath().getName() for status in self.children()]

    def make(self) -> None:
        self.fs.mkdirs(self.path)

    def remove(self) -> None:
        self.fs.delete(self.path, True)

    def qualified(self) -> str:
        """The path with the file system that Spark finds it on, for readers that do not know Spark's default."""
        return self.fs.makeQualified(self.path).toString()

    def text(self) -> str:
        """Content of a small file."""
        stream = self.fs.open(self.path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_text(self, text: str) -> None:
        stream = self.fs.create(self.path, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_to(self, target: str) -> bool:
        """Rename, never over something that exists; False if the target is taken."""
        jvm, path = self._jvm, self._jvm.org.apache.hadoop.fs.Path(target)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf())
        if context.util().exists(path):
            return False
        options = self._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(self.path), self.fs.makeQualified(path), options)
        except Py4JJavaError as taken:
            if context.util().exists(path):
                return False
            raise taken
        return True

    def modified_millis(self) -> int:
        """Time of the last change of the folder, or of what lies in it; 0 if it does not exist."""
        if not self.exists():
            return 0
        own = self.fs.getFileStatus(self.path).getModificationTime()
        return max([own, *(status.getModificationTime() for status in self.children())])

    def set_mtime(self, status, millis: int) -> None:
        self.fs.setTimes(status.getPath(), millis, -1)
