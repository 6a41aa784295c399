"""A keyed table on plain Parquet that streaming epochs can be replayed into.

``<kind>/log/epoch=<i>``   what micro-batch i brought, written with mode overwrite
``<kind>/base/epoch=<n>``  the log up to n, folded by key, for the parts that changed
``<kind>/base/epoch=<n>/_parts``  which base holds each part as of n; written last
``_checkpoint``            the checkpoint of the query that writes

The kind says how epochs fold, so that no reader takes increments for overwrites.

An epoch counts once its folder has Spark's ``_SUCCESS`` file, so a batch that
dies half-way is invisible and a batch that runs again replaces itself. What
epoch i writes depends only on the source rows and on epochs before i.

Rows are stored in parts that the key alone tells: the day of ``day_of``, or a
range of ``span`` keys. Parts never share a key, so parts without new rows are
read as they are, without a shuffle, and ``compact`` rewrites only the parts that
changed. A batch of overwrites or increments costs as much as its own rows, as
they are folded when the table is read; an insert-ignore batch reads the keys of
the parts that it touches. ``upkeep`` folds and expires on the way, so that the
number of log folders, which each read lists, stays bounded. Of the bases a read
needs the newest one's ``_parts`` alone, however many there are.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postflow.operators import merge
from postflow.schemas import MERGES, SINK_NAMES, TABLES, MergeSpec
from postflow.session import hadoop_path, path_exists

PARTS = "_parts"
# A test of part names; none takes all.
Wanted = Callable[[str], bool] | None
DAY, RANGE = "day", "key_range"
ADAPTIVE = "spark.sql.adaptive.enabled"

# How a table can be written: its own policy, or that of another job.
KINDS = ({}, {"policy": "increment"}, {"policy": "increment", "latest": True}, {"complete": True})

# Key bounds that a batch's reading is narrowed by; with more of them it reads whole parts.
MOST_BOUNDS = 100

# Epochs between two foldings by the writing job.
UPKEEP_EPOCHS = 60


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for one write.

    The session of a stateful stream has it off, as its own plan must keep its
    partitions. That plan is fixed when the sink gets the rows, so what the sink
    does with them may adapt.
    """
    had = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, had)


class EpochTable:
    """One keyed table with one writing query, whose checkpoint lies beside the data.

    A ``complete`` table gets its whole content with each epoch (``replace``)
    and only the newest epoch is read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, spec: MergeSpec,
                 names: dict[str, str] | None = None, complete: bool = False) -> None:
        self.spark = spark
        self.complete = complete
        self.path = path.rstrip("/")
        self.schema = schema
        self.spec = spec
        self.names = names or {}
        self.data = f"{self.path}/{self.kind}"
        self.checkpoint = f"{self.path}/_checkpoint"

    @property
    def kind(self) -> str:
        if self.complete:
            return "complete"
        return f"{self.spec.policy}-latest" if self.spec.latest else self.spec.policy

    @classmethod
    def named(cls, spark: SparkSession, root: str, name: str,
              policy: str | None = None, folder: str | None = None,
              complete: bool = False, latest: bool = False) -> EpochTable:
        """The table ``name`` under ``root``, with its declared schema and merge rule."""
        spec = MERGES[name]
        if policy is not None:
            spec = replace(spec, policy=policy, latest=latest)
        return cls(spark, f"{root.rstrip('/')}/{folder or name}", TABLES[name], spec,
                   SINK_NAMES[name], complete)

    @classmethod
    def stored(cls, spark: SparkSession, root: str, name: str,
               folder: str | None = None) -> EpochTable:
        """The table ``name`` as it was written, for readers that did not write it. One whose query
        has stored nothing so far is empty."""
        tables = [cls.named(spark, root, name, folder=folder, **how) for how in KINDS]
        found = [table for table in tables if path_exists(spark, table.data)]
        if not found and path_exists(spark, tables[0].checkpoint):
            return tables[0]
        if len(found) != 1:
            kinds = [table.kind for table in found] or "nothing"
            raise ValueError(f"{tables[0].path} holds {kinds}, expected one kind of table")
        return found[0]

    @property
    def part(self) -> str | None:
        """The column that parts the stored rows."""
        return DAY if self.spec.day_of is not None else RANGE if self.spec.span else None

    def _part_of(self) -> Column:
        """The part of a row: its day in UTC, whatever the session's zone, or its key range."""
        if self.spec.day_of is not None:
            days = F.floor(F.unix_seconds(self.spec.day_of) / 86_400).cast("int")
            return F.date_from_unix_date(days)
        return F.expr(f"`{self.spec.keys[0]}` div {self.spec.span}")

    # Folders -----------------------------------------------------------------

    def _folders(self, path: str, prefix: str) -> dict[str, str]:
        """Sub-folders ``<prefix>=<value>`` by value."""
        if not path_exists(self.spark, path):
            return {}
        target, files = hadoop_path(self.spark, path)
        names = [status.getPath().getName() for status in files.listStatus(target)]
        return {name.split("=", 1)[1]: f"{path}/{name}"
                for name in names if name.startswith(f"{prefix}=")}

    def _base(self, before: int | None = None) -> int:
        """The newest finished base (below ``before``); -1 if there is none."""
        mark = "_SUCCESS" if self.complete or self.part is None else PARTS
        folders = self._folders(f"{self.data}/base", "epoch")
        for epoch in sorted(map(int, folders), reverse=True):
            if (before is None or epoch < before) and path_exists(
                    self.spark, f"{folders[str(epoch)]}/{mark}"):
                return epoch
        return -1

    def _index(self, base: int) -> dict[str, int]:
        """The base that holds each part, as of one base."""
        if base < 0:
            return {}
        target, files = hadoop_path(self.spark, f"{self.data}/base/epoch={base}/{PARTS}")
        stream = files.open(target)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _write_index(self, base: int, before: dict[str, int]) -> None:
        folder = f"{self.data}/base/epoch={base}"
        index = before | dict.fromkeys(self._folders(folder, self.part), base)
        target, files = hadoop_path(self.spark, f"{folder}/{PARTS}")
        stream = files.create(target, True)
        stream.write(bytearray(json.dumps(index), "utf-8"))
        stream.close()

    def _stored(self, base: int, wanted: Wanted = None) -> dict[str, str]:
        """The newest copy of each part, as of one base."""
        if base < 0:
            return {}
        folder = f"{self.data}/base/epoch={base}"
        if self.part is None:
            return {"": folder}
        index = dict.fromkeys(self._folders(folder, self.part), base) if self.complete \
            else self._index(base)
        return {part: f"{self.data}/base/epoch={epoch}/{self.part}={part}"
                for part, epoch in index.items() if wanted is None or wanted(part)}

    def folded(self) -> tuple[int, dict[str, str]]:
        """The newest finished base (-1 if there is none), and where each part lies as of it."""
        base = self._base()
        return base, self._stored(base)

    def folded_as_of(self, base: int) -> dict[str, str]:
        """Where each part lay as of an earlier base; nothing if that base is gone."""
        mark = f"{self.data}/base/epoch={base}/{PARTS}"
        return self._stored(base) if base >= 0 and path_exists(self.spark, mark) else {}

    def _epochs(self, after: int = -1) -> dict[int, str]:
        """Finished epochs of the log beyond ``after``, oldest first."""
        found = {}
        for value, folder in self._folders(f"{self.data}/log", "epoch").items():
            if int(value) > after and path_exists(self.spark, f"{folder}/_SUCCESS"):
                found[int(value)] = folder
        return dict(sorted(found.items()))

    def _parts(self, folders: list[str], wanted: Wanted = None) -> dict[str, list[str]]:
        """Paths by part over several epochs; one nameless part where the table has none."""
        if self.part is None:
            return {"": folders} if folders else {}
        parts: dict[str, list[str]] = {}
        for folder in folders:
            for value, path in self._folders(folder, self.part).items():
                if wanted is None or wanted(value):
                    parts.setdefault(value, []).append(path)
        return parts

    def next_epoch(self) -> int:
        return max([*self._epochs(), self._base()]) + 1

    # Reading -----------------------------------------------------------------

    def _read(self, part: str, paths: list[str]) -> DataFrame:
        schema = T.StructType(self.schema.fields + [T.StructField("epoch", T.LongType())])
        if self.part is not None:
            schema = schema.add(self.part, T.DateType() if self.part == DAY else T.LongType())
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.data}/{part}")
                .parquet(*paths))

    def _fold(self, log: DataFrame) -> DataFrame:
        """Log rows of several epochs as one row per key.

        An epoch holds a key once, so ``max_by`` over the epoch has no ties.
        """
        own = [] if self.part is None else [self.part]
        keys, stamp = [*self.spec.keys, *own], self.spec.stamp
        if self.spec.policy == "overwrite":
            folded = [F.max_by(name, "epoch").alias(name) for name in self.spec.measures]
        else:
            folded = [F.sum(name).alias(name) for name in self.spec.measures]
        last = F.max(stamp) if self.spec.latest else F.max_by(stamp, "epoch")
        folded.append(last.alias(stamp))
        return log.groupBy(*keys).agg(*folded).select(*self.schema.names, *own)

    def _plan(self, before: int | None = None, wanted: Wanted = None):
        """Paths to read: cold base, base that the log touches, and the log."""
        base = self._base(before)
        log = [p for e, p in self._epochs(base).items() if before is None or e < before]
        logged, stored = self._parts(log, wanted), self._stored(base, wanted)
        cold = [path for part, path in stored.items() if part not in logged]
        warm = [path for part, path in stored.items() if part in logged]
        return cold, warm, [p for paths in logged.values() for p in paths]

    def _merged(self, warm: list[str], log: list[str]) -> DataFrame:
        if self.spec.policy == "ignore":  # each key came in once
            parts = [self._read(part, paths) for part, paths in (("base", warm), ("log", log))
                     if paths]
            return reduce(DataFrame.unionByName, parts)
        folded = self._fold(self._read("log", log))
        if not warm:
            return folded
        spec = self.spec if self.part is None else replace(
            self.spec, keys=(*self.spec.keys, self.part))
        return merge.merge(self._read("base", warm).drop("epoch"), folded, spec)

    def current(self, before: int | None = None, first: date | None = None,
                last: date | None = None) -> DataFrame:
        """The table after all finished epochs (those below ``before``).

        ``first`` and ``last`` bound the days, so that no other day's folder is read.
        """
        low, high = str(first or date.min), str(last or date.max)
        return self._content(*self._plan(
            before, (lambda day: low <= day <= high) if self.part == DAY else None))

    def _content(self, cold: list[str], warm: list[str], log: list[str]) -> DataFrame:
        parts = [self._read("base", cold)] if cold else []
        parts += [self._merged(warm, log)] if log else []
        if not parts:
            parts = [self._read("log", [])]
        tables = [part.select(*self.schema.names) for part in parts]
        return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])

    # Writing -----------------------------------------------------------------

    def _store(self, rows: DataFrame, part: str, epoch: int) -> int:
        """Write one epoch; the number of rows, counted on the way."""
        seen = Observation()
        count = F.count(F.lit(1)).alias("rows")
        folder = f"{self.data}/{part}/epoch={epoch}"
        with adaptive(rows.sparkSession):
            if self.part is None:
                rows.observe(seen, count).write.mode("overwrite").parquet(folder)
            else:
                # Tasks of even size that hold few parts each: few files, and a part
                # with most of the rows is still split. Rows are counted after the
                # shuffle: below it an empty batch would drop the count with the plan.
                parted = rows.withColumn(self.part, self._part_of()).hint("rebalance", self.part)
                options = {}
                if self.part == RANGE:
                    # Row groups of few neighbouring keys, which their bounds and filters rule out.
                    key = self.spec.keys[0]
                    parted = parted.sortWithinPartitions(self.part, key)
                    if part == "base":
                        options = {f"parquet.bloom.filter.enabled#{key}": "true",
                                   "parquet.bloom.filter.adaptive.enabled": "true"}
                (parted.observe(seen, count).write.mode("overwrite").options(**options)
                 .partitionBy(self.part).parquet(folder))
        stored = seen.get["rows"]
        if not stored:
            self._delete([folder])
        return stored

    def _delete(self, folders: list[str]) -> None:
        for folder in folders:
            target, files = hadoop_path(self.spark, folder)
            files.delete(target, True)

    def _shaped(self, rows: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
        """Columns by the table's names and types, and those that ``order`` needs besides.

        Rows without a key have no place in a table.
        """
        rows = rows.withColumnsRenamed(self.names)
        besides = [name for name in order if name not in self.schema.names]
        return rows.dropna(subset=list(self.spec.keys)).select(
            *[F.col(field.name).cast(field.dataType) for field in self.schema.fields], *besides)

    def _new_rows(self, rows: DataFrame, epoch: int, order: tuple[str, ...]) -> DataFrame:
        """First rows of the keys that earlier epochs lack.

        Only the parts that occur in the batch are read, of them only the keys, and
        of these only row groups that can hold one between the batch's least and
        greatest key there. The driver learns these bounds, a row for each part that
        the batch touches.
        """
        fresh = merge.first_per_key(rows, self.spec.keys, order)
        key = self.spec.keys[0]
        bounds = {str(row[0]): row[1:] for row in rows.groupBy(self._part_of()).agg(
            F.min(key), F.max(key)).collect()}
        plan = self._plan(before=epoch, wanted=bounds.__contains__)
        if not any(plan):
            return fresh
        stored = self._content(*plan)
        if self.part == RANGE and len(bounds) <= MOST_BOUNDS:
            stored = stored.filter(reduce(or_, [
                F.col(key) == low if low == high else F.col(key).between(low, high)
                for low, high in bounds.values()]))
        return merge.unseen(stored, fresh, self.spec)

    def write(self, rows: DataFrame, epoch: int, order: tuple[str, ...] = (),
              unique: bool = False) -> int:
        """Merge one batch as epoch ``epoch``; the number of rows it left in the log.

        ``overwrite`` takes rows that are unique by key unless ``order`` says
        which of the repeats is the last. ``increment`` sums repeats, unless the
        rows are known to be ``unique``, as a window aggregate's are.
        """
        rows = self._shaped(rows, order)
        if self.spec.policy == "ignore":
            rows = self._new_rows(rows, epoch, order)
        elif self.spec.policy == "increment":
            if not unique:
                rows = merge.deltas(rows, self.spec)
        elif order:
            rows = merge.last_per_key(rows, self.spec.keys, order)
        return self._store(rows.select(*self.schema.names), "log", epoch)

    def replace(self, rows: DataFrame, epoch: int) -> int:
        """Store the whole content of a ``complete`` table as epoch ``epoch``."""
        return self._store(self._shaped(rows), "base", epoch)

    def compact(self) -> None:
        """Fold the finished log into the base, for the days it touches.

        Epochs that finish meanwhile stay in the log.
        """
        epoch = max(self._epochs(), default=-1)
        _, warm, log = self._plan(before=epoch + 1)
        if not log:
            return
        before = self._base(epoch + 1)
        self._store(self._merged(warm, log).select(*self.schema.names), "base", epoch)
        if self.part is not None:
            self._write_index(epoch, self._index(before))

    def upkeep(self, epoch: int, every: int = UPKEEP_EPOCHS) -> None:
        """Fold after every so many epochs, and delete what the folding before made needless.

        A reader thus has the time of ``every`` epochs; the folders number about twice that.
        """
        if (epoch + 1) % every:
            return
        older = self._base(epoch + 2 - every)
        if not self.complete:
            self.compact()
        if older >= 0:
            self.expire(older)

    def expire(self, newest: int | None = None) -> None:
        """Delete epochs that no reader of the newest base, or of that one, needs.

        Readers that started before that base was made must have ended.
        """
        whole, newest = newest is None, self._base() if newest is None else newest
        gone = [folder for value, folder in self._folders(f"{self.data}/log", "epoch").items()
                if int(value) <= newest]
        bases = {int(value): folder for value, folder in
                 self._folders(f"{self.data}/base", "epoch").items() if int(value) < newest}
        if self.part is not None and not self.complete:
            # Folders of which nothing is left, and in the others what a later base holds anew:
            # that is known of the base before, and all are listed only if no base is named.
            index = self._index(newest)
            held = {base: folder for base, folder in bases.items() if base in index.values()}
            last = self._base(newest)
            if whole:
                copies = [(part, base) for base, folder in held.items()
                          for part in self._folders(folder, self.part)]
            else:
                copies = list(self._index(last).items())
            gone += [f"{held[base]}/{self.part}={part}" for part, base in copies
                     if base in held and index[part] != base]
            bases = {base: folder for base, folder in bases.items() if base not in held}
        self._delete([*gone, *bases.values()])
