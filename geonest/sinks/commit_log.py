"""Commit log of a table that is written load by load (SC7, SK6, ST1).

A load's files lie in ``load=<id>`` folders of their own, and count only once
the log has an entry for it: ``<table>/_loads/<id>.json``, put there by one
rename when everything of the load is written. So a reader sees a load whole
or not at all, whoever writes it (a batch load, a micro-batch, a compaction),
and a load that failed is never seen. An entry may name loads that it stands
for (``replaces``); these count no longer. Names that begin with an
underscore are no data to Spark's readers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

LOG = "_loads"
COMPLETE = "complete.marker"


class CommitLog:
    def __init__(self, spark: SparkSession, table_path: str):
        self.table = table_path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.table).getFileSystem(spark._jsc.hadoopConfiguration())
        self._read_all = spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray

    def _at(self, *names: str):
        return self._path("/".join([self.table, *names]))

    def exists(self) -> bool:
        return self._fs.exists(self._at(LOG, COMPLETE))

    def open(self) -> "CommitLog":
        """Make the log, before the first load writes. Loads that a table
        without a log already has are entered first; only then does the log count."""
        if not self.exists():
            if self._fs.exists(self._at()):
                for status in self._fs.listStatus(self._at()):
                    name = status.getPath().getName()
                    if name.startswith("load="):
                        self._put(f"{name[5:]}.json", {"load": name[5:], "replaces": []})
            self._put(COMPLETE, {})
        return self

    def _put(self, name: str, entry: dict) -> bool:
        """Write an entry under a name of its own, then rename: it is there whole or not at all."""
        if self._fs.exists(self._at(LOG, name)):
            return False
        draft = self._at(LOG, f".draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(json.dumps(entry).encode())
        finally:
            out.close()
        if self._fs.rename(draft, self._at(LOG, name)):
            return True
        self._fs.delete(draft, False)
        if self._fs.exists(self._at(LOG, name)):
            return False
        raise OSError(f"the entry {name} could not be put into the log of {self.table}")

    def staging(self, load: str) -> str:
        """A folder for what a load keeps until it counts; no data to readers of the table."""
        return f"{self.table}/_staged/{load}"

    def discard(self, load: str) -> None:
        self._fs.delete(self._at("_staged", load), True)

    def commit(self, load: str, replaces: list[str] = (), **figures) -> bool:
        """Make a load count. False if it already does."""
        missing = set(replaces) - set(self.loads())
        if missing:
            raise ValueError(f"loads {sorted(missing)} do not count any more")
        return self._put(f"{load}.json", {"load": load, "replaces": list(replaces), **figures})

    def has(self, load: str) -> bool:
        return self._fs.exists(self._at(LOG, f"{load}.json"))

    def entries(self) -> list[dict]:
        out = []
        for status in self._fs.listStatus(self._at(LOG)):
            name = status.getPath().getName()
            if name.endswith(".json") and not name.startswith("."):
                stream = self._fs.open(status.getPath())
                try:
                    out.append(json.loads(bytes(self._read_all(stream))))
                finally:
                    stream.close()
        return out

    def loads(self) -> list[str]:
        """The loads that count, by name."""
        entries = self.entries()
        gone = {r for e in entries for r in e.get("replaces", ())}
        return sorted(e["load"] for e in entries if e["load"] not in gone)

    def remove_replaced(self, roots: list[str]) -> list[str]:
        """Delete the files of loads that another stands for, below each of
        ``roots``; call it when no reader of before is left."""
        gone = sorted({r for e in self.entries() for r in e.get("replaces", ())})
        for root in roots:
            for load in gone:
                self._fs.delete(self._path(f"{root.rstrip('/')}/load={load}"), True)
        return gone
