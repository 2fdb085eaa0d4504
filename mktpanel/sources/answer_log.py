"""Answer log (S9): answers in batches that count once they are committed.

A key belongs to one of the log's slots for good, by its hash.  A batch of a
slot is written to a folder of its own first; then a small commit file names
that folder.  Readers take the folders that commits name and nothing else, so
a run that is killed leaves its finished batches and no half of one.

The commits of a slot are numbered.  A run writes number n + 1 only if it has
answered what was missing after number n: a commit file is renamed into place
whole and never replaced, so of two runs at once one is first and the other
drops its batch and looks again.  Each key thus has one answer.  The file
system must refuse to rename onto a file that exists, as HDFS does; object
stores without that can serve one run at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel.session import materialize

ANSWERS_SCHEMA = "symbol string, week_idx int, prompt string, answer string"
SLOTS = 16


class _Files:
    """The few file operations that a log needs, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.jvm = spark, spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        found = [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []
        return sorted(n for n in found if not n.startswith("."))

    def read(self, file: str) -> str:
        stream = self.fs.open(self.path(file))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> bool:
        """A new file, whole or not at all: written aside and renamed; False if it is there already."""
        at = self.path(file)
        aside = self.path(at.getParent(), f".{uuid.uuid4().hex}")
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.spark._jsc.hadoopConfiguration())
        kinds = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            # Without OVERWRITE a rename to a file that exists fails.
            context.rename(aside, at, self.spark.sparkContext._gateway.new_array(kinds, 0))
            return True
        except Py4JJavaError:
            self.fs.delete(aside, False)
            if self.fs.exists(at):
                return False
            raise

    def drop(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


@dataclass(frozen=True)
class Commit:
    slot: int
    number: int
    folder: str


class AnswerLog:
    """``AnswerLog(spark, path)`` opens a log or starts one with ``slots`` slots."""

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.root, self._files = spark, path.rstrip("/"), _Files(spark, path)
        held = [n for n in self._files.names(self.root) if n.startswith("slots-")]
        if not held:
            self._files.create(f"{self.root}/slots-{slots}", "")
            held = [n for n in self._files.names(self.root) if n.startswith("slots-")]
        if len(held) > 1:
            raise ValueError(f"{path} was started twice with different slots: {held}")
        self.slots = int(held[0].split("-")[1])

    # ------------------------------------------------------------ reading

    def commits(self, slot: int | None = None) -> list[Commit]:
        out = []
        for name in self._files.names(f"{self.root}/commits"):
            of, number = map(int, name.split("-"))
            if slot is None or of == slot:
                out.append(Commit(of, number, json.loads(self._files.read(f"{self.root}/commits/{name}"))["folder"]))
        return sorted(out, key=lambda c: (c.slot, c.number))

    def read(self, slot: int | None = None, upto: int | None = None) -> DataFrame:
        """All committed answers (of one slot, up to a commit number)."""
        folders = [f"{self.root}/data/{c.folder}" for c in self.commits(slot) if upto is None or c.number <= upto]
        if not folders:
            return self.spark.createDataFrame([], ANSWERS_SCHEMA)
        return self.spark.read.schema(ANSWERS_SCHEMA).parquet(*folders)

    def slot_of(self) -> Column:
        return F.pmod(F.xxhash64("symbol", "week_idx"), F.lit(self.slots)).cast("int")

    # ------------------------------------------------------------ writing

    def _commit(self, slot: int, number: int, folder: str) -> bool:
        return self._files.create(f"{self.root}/commits/{slot:05d}-{number:06d}", json.dumps({"folder": folder}))

    def append(self, prompts: DataFrame, generate: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Answer what is missing of ``prompts``, slot by slot; how many batches were committed.

        ``generate(prompts, answers)`` gives new answers for the prompts that
        have none.  The pending prompts are written once, by slot, so that
        preparing them is not repeated for every slot.
        """
        pending = prompts.join(self.read().select("symbol", "week_idx"), ["symbol", "week_idx"], "left_anti")
        pending = materialize(pending.withColumn("_slot", self.slot_of()), "pending-prompts", partition_by="_slot")
        todo = sorted(r["_slot"] for r in pending.select("_slot").distinct().collect())     # slots: a parameter
        done = 0
        for slot in todo:
            mine = pending.where(F.col("_slot") == slot).drop("_slot")
            while True:
                seen = max((c.number for c in self.commits(slot)), default=0)
                folder = f"{slot:05d}-{uuid.uuid4().hex}"
                new = generate(mine, self.read(slot, seen)).select("symbol", "week_idx", "prompt", "answer")
                new.write.parquet(f"{self.root}/data/{folder}")
                if self.spark.read.schema(ANSWERS_SCHEMA).parquet(f"{self.root}/data/{folder}").isEmpty():
                    self._files.drop(f"{self.root}/data/{folder}")
                    break
                if self._commit(slot, seen + 1, folder):
                    done += 1
                    break
                self._files.drop(f"{self.root}/data/{folder}")      # another run was first: look again
        return done

    def drop_uncommitted(self) -> list[str]:
        """Delete the folders that no commit names (of killed runs); call it while no run is writing."""
        named = {c.folder for c in self.commits()}
        gone = [n for n in self._files.names(f"{self.root}/data") if n not in named]
        for name in gone:
            self._files.drop(f"{self.root}/data/{name}")
        return gone
