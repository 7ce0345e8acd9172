"""Versions of a set of tables, published by one file each.

Data files are never changed: a writer puts the rows of its transaction under a folder of its
own, ``<root>/<table>/txn=<id>/[<partition>=<value>/]``, and then publishes the next version,
``<root>/_versions/<branch>/<number>.json``, which names the folders that each table consists of, with
their rows. The file appears whole or not at all (``fs.create_if_absent``), so

* all tables change together, and a reader that opened a version keeps reading it, whatever is
  appended, corrected or dropped meanwhile;
* a writer that breaks off at any step leaves the version as it was; its folders are in no
  version and are removed by ``vacuum``;
* of two writers that started from one version one publishes; the other starts again from the new
  version (``update``), so ids and aggregates are never derived from stale tables.

A branch starts as a copy of a version's file: it shares the data and is changed by itself.

A version's file grows with the number of folders (partitions and transactions not yet
compacted), not with rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derivspark.operators.ids import by_range
from derivspark.session import bounded_tasks
from derivspark.sources.fs import create_if_absent, delete_path, list_names, read_text

TXN = "txn"
VERSIONS = "_versions"
MAIN = "main"


class Conflict(RuntimeError):
    """Another writer published a version in between."""


def _versions(spark: SparkSession, root: str, branch: str) -> list[int]:
    names = list_names(spark, f"{root}/{VERSIONS}/{branch}")
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def _file(root: str, version: int, branch: str) -> str:
    return f"{root}/{VERSIONS}/{branch}/{version:020d}.json"


@dataclass
class Version:
    """One version of the tables under ``root``. ``tables``: name -> ``schema`` (JSON, without the
    partition column), ``partition`` (column or None), ``folders``: [partition value, txn, rows]."""
    spark: SparkSession
    root: str
    number: int = 0
    tables: dict = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    branch: str = MAIN

    def folders(self, name: str) -> list[tuple]:
        return [tuple(f) for f in self.tables.get(name, {}).get("folders", [])]

    def rows(self, name: str) -> int:
        return sum(n for _, _, n in self.folders(name))

    def partitions(self, name: str) -> list[int]:
        return sorted({p for p, _, _ in self.folders(name) if p is not None})

    def path(self, name: str, part, txn: str) -> str:
        column = self.tables[name]["partition"]
        return f"{self.root}/{name}/{TXN}={txn}" + (f"/{column}={part}" if column else "")

    def table(self, name: str, partitions=None) -> DataFrame:
        """The table's rows (of some partitions); its folders are given to the scan, which still
        prunes them by predicates on the partition column."""
        t = self.tables[name]
        schema = T.StructType.fromJson(json.loads(t["schema"]))
        if t["partition"]:
            schema = schema.add(t["partition"], T.IntegerType())
        chosen = [f for f in self.folders(name) if partitions is None or f[0] in partitions]
        if not chosen:
            return self.spark.createDataFrame([], schema)
        paths = [self.path(name, p, txn) for p, txn, _ in chosen]
        reader = self.spark.read.schema(T.StructType(schema.fields).add(TXN, T.StringType()))
        return reader.option("basePath", f"{self.root}/{name}").parquet(*paths).drop(TXN)


def open_version(spark: SparkSession, root: str, number: int | None = None, branch: str = MAIN) -> Version:
    """The latest version of a branch, or a given one; number 0, without tables, where there is none."""
    if number is None:
        number = max(_versions(spark, root, branch), default=0)
    if number == 0:
        return Version(spark, root, branch=branch)
    held = json.loads(read_text(spark, _file(root, number, branch)))
    return Version(spark, root, number, held["tables"], held["info"], branch)


def _held(number: int, operation: str, txn: str | None, tables: dict, info: dict) -> str:
    return json.dumps({"version": number, "operation": operation, "txn": txn, "published": time.time(),
                       "info": info, "tables": tables})


def fork(version: Version, branch: str) -> Version:
    """A new branch whose first version has the tables of ``version``; no data is copied."""
    held = _held(1, f"fork of {version.branch} {version.number}", None, version.tables, version.info)
    if not create_if_absent(version.spark, _file(version.root, 1, branch), held):
        raise Conflict(f"branch {branch} of {version.root} exists")
    return open_version(version.spark, version.root, branch=branch)


class Transaction:
    """Changes to a version, written but not visible until ``publish``."""

    def __init__(self, base: Version, on_step: Callable[[str], None] | None = None):
        self.base, self.spark, self.root = base, base.spark, base.root
        self.txn = f"{base.number + 1:010d}-{uuid.uuid4().hex[:12]}"
        self.tables = json.loads(json.dumps(base.tables))
        self.info = dict(base.info)
        self.on_step = on_step or (lambda name: None)
        self.written: list[str] = []

    def scratch(self, name: str) -> str:
        """A folder for intermediate tables, removed at the end."""
        path = f"{self.root}/_scratch/{self.txn}/{name}"
        return path

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the transaction's scratch folder and read back."""
        df.write.option("compression", "zstd").parquet(self.scratch(name))
        self.on_step(f"staged {name}")
        return self.spark.read.schema(df.schema).parquet(self.scratch(name))

    def unstage(self, *names: str) -> None:
        """Remove intermediate tables that nothing reads any more (else they stay to the end)."""
        for name in names:
            delete_path(self.spark, self.scratch(name))

    def add(self, name: str, df: DataFrame, partition: str | None = None, sort: list[str] | None = None,
            rows: int | None = None) -> DataFrame:
        """Add rows to a table; returns them as written. ``sort``: a unique key; rows are range
        partitioned and sorted by it, so files have narrow statistics and no key is too large for one. ``rows``: their number, if known."""
        folder = f"{self.root}/{name}/{TXN}={self.txn}"
        if folder in self.written:
            raise ValueError(f"{name} is written once in a transaction")
        self.written.append(folder)
        if sort:
            keys = [*([partition] if partition else []), *sort]
            df = by_range(df, keys, rows).sortWithinPartitions(*keys)
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(partition) if partition else writer).parquet(folder)
        self.on_step(f"wrote {name}")
        data = T.StructType([f for f in df.schema.fields if f.name != partition])
        read = self.spark.read.schema(df.schema).parquet(folder)
        if partition:  # a row a partition value that was written
            counts = [[r[0], self.txn, r[1]] for r in
                      read.groupBy(F.col(partition).cast("int")).count().collect()]
        else:
            n = read.count()
            counts = [[None, self.txn, n]] if n else []
        t = self.tables.setdefault(name, {"schema": data.json(), "partition": partition, "folders": []})
        t["folders"] = sorted(t["folders"] + counts, key=lambda f: (f[0] is not None, f[0] or 0, f[1]))
        return read

    def added(self, name: str) -> int:
        """How many rows this transaction has added to a table."""
        return sum(n for _, txn, n in self.tables[name]["folders"] if txn == self.txn)

    def drop(self, name: str, partitions=None) -> None:
        """Take a table's earlier folders (of some partitions) out of the next version."""
        t = self.tables.get(name)
        if t:
            t["folders"] = [f for f in t["folders"] if f[1] == self.txn or (partitions is not None and f[0] not in partitions)]

    def publish(self, operation: str) -> Version:
        """Make the changes the next version; ``Conflict`` if another writer was faster."""
        number = self.base.number + 1
        branch = self.base.branch
        self.on_step("before publish")
        if not create_if_absent(self.spark, _file(self.root, number, branch),
                                _held(number, operation, self.txn, self.tables, self.info)):
            raise Conflict(f"version {number} of {branch} in {self.root} exists")
        self.on_step("after publish")
        self._clear_scratch()
        return Version(self.spark, self.root, number, self.tables, self.info, branch)

    def _clear_scratch(self) -> None:
        delete_path(self.spark, f"{self.root}/_scratch/{self.txn}")

    def undo(self) -> None:
        for folder in self.written:
            delete_path(self.spark, folder)
        self._clear_scratch()


def update(spark: SparkSession, root: str, operation: str, change: Callable[[Transaction], bool | None],
           attempts: int = 5, on_step: Callable[[str], None] | None = None, branch: str = MAIN) -> Version:
    """Run ``change`` on a transaction of a branch's latest version and publish it, starting again
    where another writer was faster. ``change`` returns False if there is nothing to do."""
    for attempt in range(attempts):
        base = open_version(spark, root, branch=branch)
        t = Transaction(base, on_step)
        with bounded_tasks(spark):
            changed = change(t)
        if changed is False:
            t.undo()
            return base
        try:
            return t.publish(operation)
        except Conflict:
            t.undo()
            if attempt == attempts - 1:
                raise
    raise ValueError("no attempts")


def vacuum(spark: SparkSession, root: str, keep_versions: int = 10, min_age_hours: float = 24.0) -> list[str]:
    """Delete each branch's versions before its last ``keep_versions``, and folders that no kept
    version names and that are older than ``min_age_hours`` (a running writer's are younger).
    Listings are bounded by the number of folders."""
    named, gone = set(), []
    for branch in list_names(spark, f"{root}/{VERSIONS}"):
        numbers = sorted(_versions(spark, root, branch))
        for n in numbers[-keep_versions:]:
            v = open_version(spark, root, n, branch)
            named |= {(name, txn) for name in v.tables for _, txn, _ in v.folders(name)}
        gone += [_file(root, n, branch) for n in numbers[:-keep_versions]]
    oldest = time.time() - 3600 * min_age_hours
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in [n for n in list_names(spark, root) if n != VERSIONS]:
        for folder in list_names(spark, f"{root}/{name}"):
            txn = folder[len(TXN) + 1:] if folder.startswith(f"{TXN}=") else folder
            path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{folder}")
            if (name, txn) not in named and path.getFileSystem(conf).getFileStatus(path).getModificationTime() / 1000 <= oldest:
                gone.append(f"{root}/{name}/{folder}")
    for path in gone:
        delete_path(spark, path)
    return gone


def drop_branch(spark: SparkSession, root: str, branch: str) -> None:
    """Forget a branch; ``vacuum`` removes the data that only it had."""
    if branch == MAIN:
        raise ValueError("the main branch stays")
    delete_path(spark, f"{root}/{VERSIONS}/{branch}")
