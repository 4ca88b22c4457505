"""An index of digests in sorted files, for lookups that read little of a large table.

An index is a folder of runs. A run is a Parquet folder sorted by a 64-bit hash of the digest, with
Bloom filters and minima of that hash for each small row group, so that a lookup of few digests
skips nearly all of it. Each writer numbers its runs; when ``FANOUT`` runs of a level are there,
they are merged into one of the next level. Cost of a lookup follows the digests asked
for and the logarithm of the index, not its size, and nothing is ever too old to be found.

A run counts once its ``_SUCCESS`` mark is there, and no longer once a complete run of the same
writer covers its numbers. So a writer or a merge that dies leaves what was there before, and
readers need no lock: what a merge replaces is deleted by the merge after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwire.sources.files import complete_folders, delete_folder
from clipwire.sources.tables import DEFAULT_FORMAT, packed

HASH, DIGEST = "_hash", "_digest"
#: Runs of a level that are merged into one of the next.
FANOUT = 8
#: Bytes of a row group, rows that its Bloom filter is made for, and rows of a page.
ROW_GROUP, GROUP_ROWS, PAGE_ROWS = 1 << 20, 32_768, 512
#: Most digests that are put into the scan's filter; more of them hit most row groups anyway.
PUSHED = 1000
LIST_LIMIT = "spark.sql.parquet.pushdown.inFilterThreshold"


def digest(column: Column | str) -> Column:
    """The SHA-256 of a text or of bytes; null has the digest of nothing."""
    return F.coalesce(F.unhex(F.sha2(column, 256)), F.lit(b""))


def key_digest(keys: list[str] | tuple[str, ...]) -> Column:
    """The digest of key columns, nulls included."""
    return digest(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))


@dataclass(frozen=True)
class Run:
    """A run of a writer over the numbers ``first`` to ``last``."""

    writer: str
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"writer={self.writer}/level={self.level}-{self.first:020d}-{self.last:020d}"

    @staticmethod
    def of(writer: str, folder: str) -> Run:
        level, first, last = folder.removeprefix("level=").split("-")
        return Run(writer, int(level), int(first), int(last))

    def covers(self, other: Run) -> bool:
        inside = self.first <= other.first and other.last <= self.last
        return self.writer == other.writer and self.level > other.level and inside


@dataclass(frozen=True)
class KeyIndex:
    """The index at ``path``; rows have ``_digest`` and the columns of ``payload``."""

    spark: SparkSession
    path: str
    payload: str = ""
    row_group: int = ROW_GROUP

    @property
    def schema(self) -> T.StructType:
        columns = [f"{HASH} bigint, {DIGEST} binary", self.payload]
        return T.StructType.fromDDL(", ".join(filter(None, columns)))

    def runs(self) -> list[Run]:
        """The runs that count."""
        found = [
            Run.of(writer.removeprefix("writer="), folder)
            for writer in complete_folders(self.spark, self.path, marked=False)
            for folder in complete_folders(self.spark, f"{self.path}/{writer}")
        ]
        return sorted(
            (r for r in found if not any(o.covers(r) for o in found)), key=lambda r: (r.writer, r.first)
        )

    def has(self, writer: str, number: int) -> bool:
        """Did a writer complete the run of this number?"""
        return any(r.writer == writer and r.first <= number <= r.last for r in self.runs())

    def read(self, keep: Callable[[Run], bool] = lambda run: True) -> DataFrame:
        """All rows of the runs that ``keep`` holds for."""
        paths = [f"{self.path}/{r.name}" for r in self.runs() if keep(r)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _write(self, rows: DataFrame, run: Run) -> None:
        # A fresh run is small and only sorted within its files; merged ones are parted by hash.
        dealt = rows.repartitionByRange(HASH, DIGEST) if run.level else rows.hint("rebalance")
        ordered = dealt.sortWithinPartitions(HASH)
        (
            ordered.write.mode("overwrite")
            .options(**packed(DEFAULT_FORMAT))
            .option(f"parquet.bloom.filter.enabled#{HASH}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{HASH}", GROUP_ROWS)
            .option(f"parquet.enable.dictionary#{HASH}", "false")
            .option("parquet.block.size", self.row_group)
            .option("parquet.page.row.count.limit", PAGE_ROWS)
            .parquet(f"{self.path}/{run.name}")
        )

    def add(self, rows: DataFrame, writer: str, number: int) -> None:
        """Write the rows as a writer's run of this number, in place of what is there of it."""
        columns = self.schema.names[1:]
        hashed = rows.select(F.xxhash64(DIGEST).alias(HASH), *columns)
        self._write(hashed, Run(writer, 0, number, number))

    def lookup(self, asked: DataFrame, keep: Callable[[Run], bool] = lambda run: True) -> DataFrame:
        """The rows whose digest is a ``_digest`` of ``asked``, each once for each row of the index.

        Up to ``PUSHED`` digests go into the filter of the scan; more are joined to it. The session's
        limit for value lists in such filters is raised to that, if it is lower.
        """
        if int(self.spark.conf.get(LIST_LIMIT)) < PUSHED:
            self.spark.conf.set(LIST_LIMIT, str(PUSHED))
        wanted = asked.select(DIGEST).distinct()
        few = wanted.select(F.xxhash64(DIGEST).alias(HASH)).limit(PUSHED + 1).collect()
        rows = self.read(keep)
        if not few:
            return rows.where(F.lit(False))
        if len(few) <= PUSHED:
            rows = rows.where(F.col(HASH).isin([r[0] for r in few]))
        return rows.join(wanted, DIGEST, "left_semi").select(rows.columns)

    def merge(self, writer: str, fanout: int = FANOUT) -> None:
        """Merge the writer's runs, level by level, where ``fanout`` of them are together."""
        self._drop_covered(writer)
        while full := self._full_level(writer, fanout):
            rows = self.read(lambda run: run in full)
            self._write(rows.dropDuplicates(), Run(writer, full[0].level + 1, full[0].first, full[-1].last))

    def _full_level(self, writer: str, fanout: int) -> list[Run]:
        mine = [r for r in self.runs() if r.writer == writer]
        for level in sorted({r.level for r in mine}):
            same = [r for r in mine if r.level == level]
            if len(same) >= fanout:
                return same
        return []

    def _drop_covered(self, writer: str) -> None:
        live = self.runs()
        for folder in complete_folders(self.spark, f"{self.path}/writer={writer}"):
            run = Run.of(writer, folder)
            if any(o.covers(run) for o in live):
                delete_folder(self.spark, f"{self.path}/{run.name}")
