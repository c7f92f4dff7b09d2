"""Tables with numbered versions, kept as ordinary Parquet folders.

``root/data/`` holds one folder per write and ``root/commits/`` one small record
per version: the columns of the version and the folders it consists of. The
record is written last, so a write that dies half way leaves a folder nobody
reads, and can simply be run again. ``overwrite`` writes the whole table,
``append`` only the new rows, ``merge`` only the batch, and ``add_column`` no rows
at all. One writer at a time: two writers could both take the same version number.

A merged folder says by which keys it replaces rows of the folders before it. The
folders of a version are numbered; a reader makes one table of the keys of all merged
folders, with the number of the last that holds each, and one left join with it drops
the rows of folders before that number. So a read has one join however many merges
there were (one per set of key columns, if merges differ in it), and a merge costs
later reads its own rows and, once more, its keys; ``overwrite`` with the current rows
gathers the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import keeps_all, name_rule
from ..operators.upsert import as_target_rows, reject_ambiguous
from .tables import spread_for_write

_RECORD = (
    "version bigint, committed_at timestamp, operation string, n_rows bigint, "
    "columns string, "
    "folders array<struct<path: string, columns: string, keys: array<string>>>"
)


@dataclass(frozen=True)
class Folder:
    """Files of one write; with ``keys``, they replace earlier rows of those keys."""

    path: str
    columns: str
    keys: tuple[str, ...] = ()


def _folders(record: Row) -> list[Folder]:
    return [Folder(f["path"], f["columns"], tuple(f["keys"])) for f in record["folders"]]


def _schema(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


class VersionedTable:
    """Numbered versions 0, 1, 2, ... of one table below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- writing ---------------------------------------------------------

    def overwrite(
        self,
        df: DataFrame,
        operation: str = "WRITE",
        partition_by: Sequence[str] = (),
        rebalance: bool = True,
    ) -> int:
        """Commit ``df`` with its own schema as the next version.

        ``rebalance=False`` saves the shuffle where ``df`` still lies in files
        by partition value, as rows that were only filtered or changed do.
        """
        latest = self.latest_version()
        version = 0 if latest is None else latest + 1
        folder = self._write_folder(df, version, partition_by, rebalance)
        return self._commit(version, operation, df.schema, [folder], self._count(folder))

    def append(
        self,
        df: DataFrame,
        operation: str = "APPEND",
        partition_by: Sequence[str] = (),
    ) -> int:
        """Commit the current rows plus ``df``; columns absent on either side
        are NULL there.

        Names are compared as the session does. A column of another type than
        the table's is cast if that loses nothing; else nothing is written and
        ValueError is raised.
        """
        latest = self._record()
        version = 0 if latest is None else latest["version"] + 1
        if latest is None:
            folder = self._write_folder(df, version, partition_by, rebalance=True)
            return self._commit(version, operation, df.schema, [folder], self._count(folder))
        known = _schema(latest["columns"])
        df, added = self._fitted(df, known)
        columns = StructType([*known.fields, *added])
        folder = self._write_folder(df, version, partition_by, rebalance=True)
        folders = [*_folders(latest), folder]
        n_rows = latest["n_rows"] + self._count(folder)
        return self._commit(version, operation, columns, folders, n_rows)

    def add_column(self, name: str, data_type: str, operation: str = "EVOLVE") -> int:
        """Commit the current rows with one more column, NULL in every row.

        The new version names the folders of the current one, so the cost does
        not depend on the size of the table.
        """
        latest = self._latest()
        columns = _schema(latest["columns"])
        if self._same(name) in map(self._same, columns.names):
            raise ValueError(f"column {name} is already there")
        columns = StructType([*columns.fields, *StructType.fromDDL(f"{name} {data_type}").fields])
        return self._commit(
            latest["version"] + 1, operation, columns, _folders(latest), latest["n_rows"]
        )

    def merge(
        self,
        batch: DataFrame,
        key: str | Sequence[str],
        operation: str = "MERGE",
        partition_by: Sequence[str] = (),
        rebalance: bool = True,
    ) -> int:
        """Commit the current rows with ``batch`` merged in by ``key``.

        A row whose key is in the batch is replaced by the batch row, NULLs
        included; other batch rows are added; a NULL key matches nothing. Two
        batch rows for one row raise ValueError, as does a column of another type
        than the table's unless the cast loses nothing; columns that the table
        lacks are left out. Only the batch is written. One pass over the key
        columns counts the rows that it replaces.
        """
        latest = self._latest()
        columns, version = _schema(latest["columns"]), latest["version"] + 1
        names = {self._same(c): c for c in columns.names}
        keys = [names.get(self._same(k), k) for k in ([key] if isinstance(key, str) else key)]
        rows = as_target_rows(batch, columns)
        written = self._write_folder(rows, version, partition_by, rebalance)
        new = Folder(written.path, written.columns, tuple(keys))
        incoming, current = self._scan(new), self._rows(latest)
        reject_ambiguous(current, incoming, keys)
        replaced = current.select(*keys).join(incoming.select(*keys), keys, "left_semi").count()
        n_rows = latest["n_rows"] - replaced + self._count(new)
        return self._commit(version, operation, columns, [*_folders(latest), new], n_rows)

    # -- reading ---------------------------------------------------------

    def current(self) -> DataFrame:
        """The rows of the latest version."""
        return self._rows(self._latest())

    def as_of(self, version: int) -> DataFrame:
        """The rows of one version, with the columns that version had."""
        record = self._record(version)
        if record is None:
            raise ValueError(f"version {version} was never committed at {self.root}")
        return self._rows(record)

    def latest_version(self) -> int | None:
        record = self._record()
        return None if record is None else record["version"]

    def history(self) -> DataFrame:
        """One row per version: what wrote it, when, and its number of rows."""
        records = self._records()
        if records is None:
            raise ValueError(f"no version committed at {self.root}")
        return records.select("version", "committed_at", "operation", "n_rows").orderBy("version")

    def diff(self, *versions: int) -> DataFrame:
        """Counted rows and column list of each given version."""
        summaries = []
        for version in versions:
            rows = self.as_of(version)
            summaries.append(
                rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
                    F.lit(version).cast("bigint").alias("version"),
                    "n_rows",
                    F.lit(len(rows.columns)).alias("n_cols"),
                    F.lit(",".join(rows.columns)).alias("columns"),
                )
            )
        return reduce(DataFrame.unionByName, summaries)

    # -- columns ---------------------------------------------------------

    def _same(self, name: str) -> str:
        """What two names have in common if the session takes them for one."""
        return name_rule(self.spark)(name)

    def _fitted(self, df: DataFrame, known: StructType) -> tuple[DataFrame, list[StructField]]:
        """``df`` with the names and types of the known columns, and its new ones."""
        by_name = {self._same(f.name): f for f in known.fields}
        seen: set[str] = set()
        picked, added = [], []
        for field in df.schema.fields:
            same = self._same(field.name)
            if same in seen:
                raise ValueError(f"column {field.name} is there twice")
            seen.add(same)
            into = by_name.get(same)
            if into is None:
                added.append(field)
                picked.append(F.col(field.name))
            elif keeps_all(field.dataType, into.dataType):
                picked.append(F.col(field.name).cast(into.dataType).alias(into.name))
            else:
                raise ValueError(
                    f"column {field.name} is {field.dataType.simpleString()}, in the table "
                    f"{into.dataType.simpleString()}"
                )
        return df.select(*picked), added

    # -- layout ----------------------------------------------------------

    def _records(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_RECORD).parquet(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _record(self, version: int | None = None) -> Row | None:
        """The record of one version, by default of the latest."""
        records = self._records()
        if records is None:
            return None
        if version is not None:
            records = records.filter(F.col("version") == version)
        return records.orderBy(F.desc("version")).first()

    def _latest(self) -> Row:
        record = self._record()
        if record is None:
            raise ValueError(f"no version committed at {self.root}")
        return record

    def _rows(self, record: Row) -> DataFrame:
        columns, folders = _schema(record["columns"]), _folders(record)
        number = "_folder"
        while any(self._same(c).startswith(number) for c in columns.names):
            number = f"_{number}"
        parts = [
            self._with_columns(self._scan(folder), folder, columns).withColumn(number, F.lit(i))
            for i, folder in enumerate(folders)
        ]
        # Rows of the last merged folder and of later ones are not replaced.
        last = max((i for i, folder in enumerate(folders) if folder.keys), default=0)
        union = lambda rows: reduce(DataFrame.unionByName, rows)
        if last:
            replaceable = union(parts[:last])
            for keys, merged in self._replaced_keys(folders, number).items():
                ending = f"{number}_last"
                replaceable = replaceable.join(
                    merged.withColumnRenamed(number, ending), list(keys), "left"
                ).filter(F.col(ending).isNull() | (F.col(number) >= F.col(ending)))
                replaceable = replaceable.select(*columns.names, number)
            parts[:last] = [replaceable]
        return union(parts).select(*columns.names)

    def _replaced_keys(
        self, folders: list[Folder], number: str
    ) -> dict[tuple[str, ...], DataFrame]:
        """For each set of key columns by which folders were merged: every key, and
        the number of the last folder that was merged with it."""
        merged: dict[tuple[str, ...], list[DataFrame]] = {}
        for i, folder in enumerate(folders):
            if folder.keys:
                keys = self._scan(folder).select(*folder.keys).dropna()
                merged.setdefault(tuple(sorted(folder.keys)), []).append(
                    keys.withColumn(number, F.lit(i))
                )
        return {
            keys: reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.max(number).alias(number))
            for keys, parts in merged.items()
        }

    def _write_folder(
        self, df: DataFrame, version: int, partition_by: Sequence[str], rebalance: bool
    ) -> Folder:
        path = f"data/v{version:06d}-{uuid.uuid4().hex}"
        rows = spread_for_write(df, partition_by) if rebalance else df
        writer = rows.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{path}")
        return Folder(path, df.schema.json())

    def _scan(self, folder: Folder) -> DataFrame:
        # With the recorded schema, partition values keep their type; inference
        # would turn a region named "7" into a number.
        return self.spark.read.schema(_schema(folder.columns)).parquet(
            f"{self.root}/{folder.path}"
        )

    def _with_columns(self, rows: DataFrame, folder: Folder, columns: StructType) -> DataFrame:
        """All columns of a version, in order; NULL where the folder lacks one."""
        stored = _schema(folder.columns).names
        return rows.select(
            *(
                f.name if f.name in stored else F.lit(None).cast(f.dataType).alias(f.name)
                for f in columns.fields
            )
        )

    def _count(self, folder: Folder) -> int:
        # Counted from the written files, whose footers hold the row counts:
        # right even if tasks were run again during the write.
        return self._scan(folder).count()

    def _commit(
        self,
        version: int,
        operation: str,
        columns: StructType,
        folders: list[Folder],
        n_rows: int,
    ) -> int:
        text = json.dumps(
            {
                "version": version,
                "operation": operation,
                "n_rows": n_rows,
                "columns": columns.json(),
                "folders": [asdict(folder) for folder in folders],
            }
        )
        record = (
            self.spark.range(1)
            .select(F.from_json(F.lit(text), _RECORD).alias("record"))
            .select("record.*")
            .withColumn("committed_at", F.current_timestamp())
        )
        record.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return version
