"""Recoverable replacement of the partitions of a table folder.

A run writes its new partitions to a folder of its own inside the table,
``_staged-<run>``, which scans don't see. The commit first writes a
journal, ``_commit.json``, with everything that is to be moved, and then
renames: an old partition out of the way, the new one into its place. The
next run on the table calls :func:`recover` before it reads anything: with
a journal it finishes the moves that are left, without one it deletes what
a run that never reached its commit has staged. A partition is thus either
the old or the new one as a whole, a repeated run never works on a half
replaced table, and nothing is written twice.

Between the two renames of a partition a reader doesn't see it. Object
stores without a rename copy instead; there that moment is longer.
Concurrent writers to one table are not supported.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

JOURNAL = "_commit.json"
STAGED, OLD = "_staged-", "_old-"


class _Files:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def names(self, p: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(p))] if self.exists(p) else []

    def move(self, a: str, b: str) -> None:
        self.fs.mkdirs(self.path(b).getParent())
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"could not rename {a} to {b}")

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def write(self, p: str, text: str) -> None:
        """A file that is there as a whole or not at all."""
        out = self.fs.create(self.path(p + ".tmp"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.delete(p)
        self.move(p + ".tmp", p)

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def staged_path(table: str, run: str) -> str:
    return f"{table}/{STAGED}{run}"


def commit_staged(spark: SparkSession, table: str, run: str, added: dict[str, str] | None = None,
                  planned: set[str] | None = None, progress: Callable[[str], None] | None = None) -> list[str]:
    """Put the partitions that ``run`` has staged into the table; returns their names.

    ``added`` maps further staged folders to folders of the table whose
    files they join (the id index). Of the partitions in ``planned`` those
    that aren't staged have no rows any more and go. ``progress`` is called
    with the name of each partition after it was replaced.
    """
    files = _Files(spark, table)
    staged = staged_path(table, run)
    partitions = sorted(n for n in files.names(staged) if "=" in n and not n.startswith("_"))
    moves = [[f"{staged}/{n}", f"{table}/{n}"] for n in partitions]
    joins = [[f"{a}/{n}", f"{b}/{n}"] for a, b in (added or {}).items() for n in sorted(files.names(a))
             if not n.startswith((".", "_SUCCESS"))]
    gone = sorted((planned or set()) - set(partitions))
    files.write(f"{table}/{JOURNAL}", json.dumps({"run": run, "replace": moves, "add": joins, "drop": gone}))
    _finish(files, table, progress)
    return partitions


def _finish(files: _Files, table: str, progress: Callable[[str], None] | None = None) -> str:
    """Carry out what is left of the journal; may be repeated at any point."""
    journal = json.loads(files.read(f"{table}/{JOURNAL}"))
    run = journal["run"]
    for new, place in journal["replace"]:
        name = place.rsplit("/", 1)[1]
        if files.exists(new):
            if files.exists(place):
                files.move(place, f"{table}/{OLD}{run}/{name}")
            files.move(new, place)
            if progress:
                progress(name)
    for name in journal["drop"]:
        if files.exists(f"{table}/{name}"):
            files.move(f"{table}/{name}", f"{table}/{OLD}{run}/{name}")
    for new, place in journal["add"]:
        if files.exists(new):
            files.delete(place)
            files.move(new, place)
    files.delete(f"{table}/{OLD}{run}")
    files.delete(staged_path(table, run))
    files.delete(f"{table}/{JOURNAL}")
    return run


def recover(spark: SparkSession, table: str) -> str | None:
    """Finish an interrupted commit and clear what unfinished runs left; returns the run that was finished."""
    files = _Files(spark, table)
    run = _finish(files, table) if files.exists(f"{table}/{JOURNAL}") else None
    for n in files.names(table):
        if n.startswith((STAGED, OLD)) or n == JOURNAL + ".tmp":
            files.delete(f"{table}/{n}")
    return run
