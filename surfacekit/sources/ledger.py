"""SNK2: an append-only sink with a commit protocol.

A sink is a folder with ``data/<id>`` folders of Parquet files and a ledger ``commits/<version>``
of small JSON files, one for each commit, numbered without gaps. What no commit names is not
part of the sink, so a writer that dies leaves nothing behind that a reader sees. A version is
claimed by renaming a complete file to its name, which fails where the name is taken: of two
writers one is first, and the other looks at what was committed meanwhile before it tries the
next number. Both use Hadoop's file API, so the sink can be in any store that Spark writes to
whose rename does not overwrite (HDFS; object stores need a committer with conditional writes).
In a local folder a rename at the same moment overwrites; there the name is a hard link, made once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Commit:
    """One commit: its version, what named it (a batch id, or a fresh id), its folder and rows."""

    version: int
    name: str
    folder: str | None
    rows: int


class CommitConflict(RuntimeError):
    """Other writers were first at every attempt."""


class Ledger:
    """The sink at ``path``. ``attempts`` bounds the tries of one append against other writers."""

    def __init__(self, spark: SparkSession, path: str, attempts: int = 20) -> None:
        self.spark, self.path, self.attempts = spark, path.rstrip("/"), attempts
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------------ files
    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._at("commits").getFileSystem(self._conf)

    def _put_new(self, version: int, text: str) -> bool:
        """Writes a commit file; False where the version is taken."""
        fs, final, draft = self._fs(), self._at("commits", f"{version:010d}"), self._at("drafts", uuid.uuid4().hex)
        fs.mkdirs(final.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        local = fs.resolvePath(final.getParent()).toUri().getScheme() == "file"
        try:
            if local:
                self._jvm.java.nio.file.Files.createLink(self._local(final), self._local(draft))
            else:
                self._rename(draft, final)
        except Exception as e:
            if fs.exists(final):
                fs.delete(draft, False)
                return False
            raise e
        if local:
            fs.delete(draft, False)
        return True

    def _local(self, path):
        folder = self._fs().resolvePath(path.getParent()).toUri().getPath()
        return self._jvm.java.io.File(folder, path.getName()).toPath()

    def _rename(self, draft, final) -> None:
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(self._jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        context.rename(draft, final, options)

    def _text(self, path) -> str:
        stream = self._fs().open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # ------------------------------------------------------------------ reading
    def commits(self, after: int = 0) -> list[Commit]:
        """The commits beyond a version, in order."""
        fs, folder = self._fs(), self._at("commits")
        if not fs.exists(folder):
            return []
        names = sorted(f.getPath().getName() for f in fs.listStatus(folder))
        found = [n for n in names if n.isdigit() and int(n) > after]
        return [Commit(int(n), **json.loads(self._text(self._at("commits", n)))) for n in found]

    def read(self, commits: list[Commit] | None = None) -> DataFrame | None:
        """The rows of the given commits (all of them); None where there are none."""
        chosen = [c for c in (self.commits() if commits is None else commits) if c.folder]
        if not chosen:
            return None
        return reduce(DataFrame.unionByName, (self.spark.read.parquet(f"{self.path}/data/{c.folder}") for c in chosen[:1])) if len(chosen) == 1 else (
            self.spark.read.parquet(*[f"{self.path}/data/{c.folder}" for c in chosen]))

    # ------------------------------------------------------------------ writing
    def append_new(self, incoming: DataFrame, key: str, name: str | None = None) -> int:
        """Appends the rows whose ``key`` the sink lacks, one for each key, and returns their number.
        An append under a ``name`` that is already committed does nothing and returns 0, so a
        retry after a failure, or a batch played again, appends once. Null keys are a key."""
        held = self.commits()
        if name is not None and any(c.name == name for c in held):
            return 0
        name = name or uuid.uuid4().hex
        fresh, seen = _lacking(incoming.dropDuplicates([key]), self.read(held), key), held
        for _ in range(self.attempts):
            folder, rows = self._stage(fresh)
            if self._put_new(len(seen) + 1, json.dumps({"name": name, "folder": folder if rows else None, "rows": rows})):
                return rows
            # another writer was first: of the staged rows, those stay that it did not bring
            newer = self.commits(after=len(seen))
            if any(c.name == name for c in newer):
                return 0
            staged = self.spark.read.schema(incoming.schema).parquet(f"{self.path}/data/{folder}")
            fresh, seen = _lacking(staged, self.read(newer), key), [*seen, *newer]
        raise CommitConflict(f"{self.attempts} appends to {self.path} met other writers")

    def _stage(self, rows: DataFrame) -> tuple[str, int]:
        folder, seen = uuid.uuid4().hex, Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/data/{folder}")
        return folder, seen.get["n"]

    def remove_strays(self) -> int:
        """Deletes data folders that no commit names, and drafts. For when no writer is at work."""
        fs, kept = self._fs(), {c.folder for c in self.commits()}
        strays = [f.getPath() for top in ("data", "drafts") if fs.exists(self._at(top)) for f in fs.listStatus(self._at(top)) if f.getPath().getName() not in kept]
        for path in strays:
            fs.delete(path, True)
        return len(strays)


def _lacking(rows: DataFrame, held: DataFrame | None, key: str) -> DataFrame:
    if held is None:
        return rows
    known = held.select(F.col(key).alias("_known")).distinct()
    return rows.join(known, rows[key].eqNullSafe(known["_known"]), "left_anti")
