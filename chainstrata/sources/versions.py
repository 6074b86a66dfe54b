"""Versions of batches, and which source versions a derived batch was built from.

Every write to a batch leaves a line in a small log beside the data, in a folder
that readers of the table skip. A version is an arbitrary name that changes with
every write, so late rows, replaced rows and removals show alike, whatever they do
to row counts or newest heights. What is due follows from the logs alone: no data
is read. The log has a line per batch of blocks; its newest state is read by the
driver, some thousand lines for the longest chains.

A batch is marked as open before its files change and gets its version afterwards.
After a crash in between it is still open: a derived batch counts as due, and a
source batch is waited for until its own load is repeated. One writer per table.

Beside the log lies the width of the batches in blocks, if it is not the usual one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

FOLDER = "_versions"
WIDTH = "width.txt"
OPEN = "open:"
# Log files are folded into one beyond this number.
FOLD = 50


@dataclass
class Entry:
    version: str
    built_from: dict[str, str] = field(default_factory=dict)

    @property
    def open(self) -> bool:
        return self.version.startswith(OPEN)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(where)] if fs.exists(where) else []
    return fs, sorted((p for p in found if p.getName().endswith(".json")), key=lambda p: p.getName())


def _text(spark: SparkSession, fs, file) -> str:
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, fs, target: str, text: str) -> None:
    """The file appears whole or not at all."""
    making = spark._jvm.org.apache.hadoop.fs.Path(f"{target}.making")
    out = fs.create(making, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(making, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{target} exists: two writers on one table")


def text(spark: SparkSession, file: str) -> str:
    """A small file as text."""
    where = spark._jvm.org.apache.hadoop.fs.Path(file)
    return _text(spark, where.getFileSystem(spark._jsc.hadoopConfiguration()), where)


def put(spark: SparkSession, file: str, content: str) -> None:
    """Write a small file that appears whole or not at all."""
    where = spark._jvm.org.apache.hadoop.fs.Path(file)
    _put(spark, where.getFileSystem(spark._jsc.hadoopConfiguration()), file, content)


def width(spark: SparkSession, path: str, usual: int) -> int:
    """Blocks per batch of a table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}/{WIDTH}")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(_text(spark, fs, where)) if fs.exists(where) else usual


def keep_width(spark: SparkSession, path: str, blocks: int | None, usual: int) -> int:
    """The width of a table, which a new one takes from ``blocks``; another width later is an error."""
    fs, files = _files(spark, path)
    held = width(spark, path, usual)
    if blocks is None or blocks == held:
        return held
    if files or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}/{WIDTH}")):
        raise ValueError(f"{path} has batches of {held} blocks, not {blocks}")
    _put(spark, fs, f"{path}/{FOLDER}/{WIDTH}", str(blocks))
    return blocks


def _append(spark: SparkSession, path: str, lines: list[dict]) -> None:
    """One file per call, named by a running number; it appears whole or not at all."""
    fs, files = _files(spark, path)
    number = int(files[-1].getName().split(".")[0]) + 1 if files else 0
    _put(spark, fs, f"{path}/{FOLDER}/{number:012d}.json", "\n".join(map(json.dumps, lines)))


def state(spark: SparkSession, path: str) -> dict[int, Entry]:
    """The newest entry of every batch that exists."""
    fs, files = _files(spark, path)
    newest = {}
    for file in files:
        for line in map(json.loads, _text(spark, fs, file).splitlines()):
            newest[line["batch_id"]] = line
    out = {b: Entry(x["version"], x.get("built_from") or {}) for b, x in newest.items() if x["version"] is not None}
    if len(files) > FOLD:
        _append(spark, path, [{"batch_id": b, "version": e.version, "built_from": e.built_from} for b, e in out.items()])
        for old in files:
            fs.delete(old, False)
    return out


def begin(spark: SparkSession, path: str, batches: Iterable[int]) -> None:
    """Mark batches whose files are about to change."""
    mark = OPEN + uuid.uuid4().hex
    lines = [{"batch_id": b, "version": mark} for b in batches]
    if lines:
        _append(spark, path, lines)


def commit(spark: SparkSession, path: str, batches: Iterable[int], built_from: dict[int, dict[str, str]] | None = None,
           gone: Iterable[int] = ()) -> None:
    """Give written batches a new version and strike the batches that are gone."""
    version, sources = uuid.uuid4().hex, built_from or {}
    lines = [{"batch_id": b, "version": version, "built_from": sources.get(b, {})} for b in batches]
    lines += [{"batch_id": b, "version": None} for b in gone]
    if lines:
        _append(spark, path, lines)


def due(spark: SparkSession, sources: dict[str, str], lead: str, target: str) -> tuple[dict[int, dict[str, str]], list[int]]:
    """Batches of ``target`` to build, with the source versions they are built from, and batches to remove.

    ``lead`` names the source whose batches ``target`` has. Batches some source is
    still writing wait.
    """
    held = {name: state(spark, path) for name, path in sources.items()}
    built = state(spark, target)
    todo = {}
    for batch in held[lead]:
        entries = {name: entries[batch] for name, entries in held.items() if batch in entries}
        if any(e.open for e in entries.values()):
            continue
        now = {name: e.version for name, e in entries.items()}
        if batch not in built or built[batch].open or built[batch].built_from != now:
            todo[batch] = now
    return todo, sorted(set(built) - set(held[lead]))
