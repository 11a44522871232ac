"""A versioned key/cell table: batches are appended, the last write of a cell wins on read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cells import MAX_VERSIONS, keep_versions, latest_cells
from millrace.schemas import CELL
from millrace.session import Folder, current_run
from millrace.sinks.commits import CommitLog, Entry, State

STORED = T.StructType(CELL.fields + [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
KEEP_SECONDS = 3600.0


class CellTable:
    """Writing a batch touches only that batch's rows; nothing that exists is rewritten.

    A log of commits (:class:`CommitLog`) says which folders are the table: ``cells/<run>-<batch>-<id>`` holds a micro-batch,
    ``merged/<id>`` the cells of several of them. Every cell keeps the run and batch that wrote it, also in merged folders:
    later runs win over earlier ones, later batches over earlier ones of their run, whenever they are committed. A
    batch is committed when it is complete, a replayed batch takes the place of its first writing, and a merge takes
    away the folders it has read and no others: a batch that is being written meanwhile is none of them. Of two merges
    of the same folders the second is given up.

    ``versions`` is the number of timestamps kept for each cell (None: all). With ``merge_every``, a merge follows when so many
    batches have not been merged, which bounds what a read has to combine. A reader has the folders of one version;
    those that a merge replaces are deleted ``keep_seconds`` later.
    """

    def __init__(self, spark: SparkSession, path: str, versions: int | None = MAX_VERSIONS, merge_every: int | None = None, keep_seconds: float = KEEP_SECONDS):
        self.spark = spark
        self.path = path.rstrip("/")
        self.versions, self.merge_every, self.keep_seconds = versions, merge_every, keep_seconds
        self.log = CommitLog(spark, self.path)

    def write(self, cells: DataFrame, batch_id: int) -> None:
        """Idempotent: a replayed batch replaces what its first try committed.

        Repeated writes of a cell in one batch: the greatest ``write_order`` wins where the frame has that
        column, else the greatest value.
        """
        self.commit(self.stage(cells, batch_id), batch_id)
        if self.merge_every and len(self.batches()) >= self.merge_every:
            self.merge()

    def stage(self, cells: DataFrame, batch_id: int) -> str:
        """Write a batch's rows to a folder that nobody reads yet."""
        order = "write_order" if "write_order" in cells.columns else "value"
        folder = f"cells/{self._run()}-{batch_id:020d}-{uuid.uuid4().hex}"
        latest_cells(cells, [order]).write.parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, folder: str, batch_id: int) -> int:
        """Make a staged batch part of the table; returns the version that has it."""
        run = self._run()

        def change(now: State) -> dict:
            again = [f for f, about in now.live.items() if (about.get("run"), about.get("batch")) == (run, batch_id)]
            return {"add": [Entry(folder, {"run": run, "batch": batch_id})], "remove": again}

        return self.log.commit(change).version

    def _run(self) -> str:
        """This query's name among the runs, in order of their first batch; taken once, found again after a restart."""
        query = current_run(self.spark)

        def change(now: State) -> dict | None:
            return None if query in now.names else {"names": [query]}

        return f"{self.log.commit(change).names.index(query):08d}"

    def version(self) -> int:
        """Number of the last commit, -1 for a new table."""
        return self.log.state().version

    def batches(self, version: int | None = None) -> list[tuple[str, int]]:
        """(run, batch) of every folder that is not merged."""
        return sorted((about["run"], about["batch"]) for about in self.log.state(version).live.values() if "run" in about)

    def snapshots(self, version: int | None = None) -> list[int]:
        """Numbers of the merged folders that are part of the table: one at most."""
        return sorted(about["snapshot"] for about in self.log.state(version).live.values() if "snapshot" in about)

    def read(self, version: int | None = None) -> DataFrame:
        """Latest value of every (row key, family, qualifier, timestamp), newest ``versions`` timestamps; what later commits
        do, merges included, does not change the frame. ``version`` reads an earlier state that is still kept."""
        return self._current(self.log.state(version)).select(*CELL.fieldNames())

    def _current(self, state: State) -> DataFrame:
        parts = self.spark.createDataFrame([], STORED)
        merged = [f"{self.path}/{folder}" for folder, about in state.live.items() if "snapshot" in about]
        batches = [f"{self.path}/{folder}" for folder, about in state.live.items() if "snapshot" not in about]
        if batches:
            # One read of all batches; a batch's order comes from its folder's name.
            name = F.split(F.element_at(F.split(F.input_file_name(), "/"), -2), "-")
            order = [name[0].alias("run"), name[1].cast("bigint").alias("batch_id")]
            parts = parts.unionByName(self.spark.read.schema(CELL).parquet(*batches).select("*", *order))
        if merged:
            parts = parts.unionByName(self.spark.read.schema(STORED).parquet(*merged))
        order = F.struct("run", "batch_id")
        last = F.max_by(F.struct("value", "run", "batch_id"), order)
        current = parts.groupBy("row_key", "family", "qualifier", "ts_micros").agg(last.alias("_last"))
        current = current.select("row_key", "family", "qualifier", "ts_micros", "_last.*")
        return current if self.versions is None else keep_versions(current, self.versions, STORED.fieldNames())

    def merge(self) -> None:
        """Put everything committed so far into one folder, and delete what was replaced ``keep_seconds`` ago or more."""
        before = self.log.state()
        if len(before.live) > 1:
            folder = f"merged/{uuid.uuid4().hex}"
            self._current(before).write.parquet(f"{self.path}/{folder}")

            def change(now: State) -> dict | None:
                taken = set(before.live)
                number = 1 + max((about["snapshot"] for about in now.live.values() if "snapshot" in about), default=-1)
                return {"add": [Entry(folder, {"snapshot": number})], "remove": taken} if taken <= set(now.live) else None

            self.log.commit(change)
        self.vacuum()

    def vacuum(self, keep_seconds: float | None = None) -> list[str]:
        """Delete folders that no reader of the last ``keep_seconds`` can have, batches that were never committed included."""
        there = [f"{kind}/{name}" for kind in ("cells", "merged") for name in Folder(self.spark, f"{self.path}/{kind}").names()]
        return self.log.vacuum(there, self.keep_seconds if keep_seconds is None else keep_seconds)
