"""A keyed table kept as parquet folders, split by month.

Plain parquet cannot be overwritten while it is read, nor merged in place. A
merge writes the months it changes into a folder of its own, and an entry in the
commit log makes them the ones readers see; months without a replaced key stay
where they are. A job that dies half way leaves no entry, and no later attempt
writes to, or reads, the folder it left.

With a key index a merge knows from what was written beside the pieces which of them
may hold a key of the batch, and opens no other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelattice.session import freed_shuffles, settings, small_splits
from carelattice.sources import key_index
from carelattice.operators.incremental import (
    deduplicate,
    first_of_both,
    without_keys,
    without_repeated_keyless,
)

_ENTRY_DDL = "version bigint, batch string, fields string, pieces array<struct<part:string,path:string,index:string>>"
_ATTEMPT, _PART = "snapshot_attempt", "snapshot_part"
_UNDATED = "none"


def _union(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The fields of both; a field of another type is refused."""
    fields = {f.name: f for f in (old.fields if old else [])}
    for f in new.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} was {fields[f.name].dataType.simpleString()}, "
                             f"now {f.dataType.simpleString()}")
        fields.setdefault(f.name, f)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


class SnapshotTable:
    """One table with a single writer at a time and any number of readers.

    ``dated_by`` is the timestamp column whose month, or year with
    ``split="year"`` for small tables, splits the table; without it the table is
    one part. ``indexed_by`` is the key by which it is merged; pieces written without
    an index, or under another key, are always opened.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, dated_by: str | None = None,
                 split: str = "month", indexed_by: str | None = None):
        self.spark = spark
        self.name = name
        self._indexed_by = indexed_by
        # The pieces the last merge read keys from, as (part, path).
        self.opened: list[tuple[str, str]] = []
        self._dated_by = dated_by
        self._digits = {"month": len("2024-01"), "year": len("2024")}[split]
        self._data = f"{root}/{name}/data"
        self._log = f"{root}/{name}/commits"
        self._incoming = f"{root}/{name}/incoming"
        self._indexes = f"{root}/{name}/index"

    # ---- reading

    def _entries(self) -> list[str]:
        """Files of the commit log, oldest first. Their names tell version and batch, so none is opened."""
        try:
            files = self.spark.read.text(self._log, recursiveFileLookup=True).inputFiles()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(files, key=lambda f: f.split("/")[-2])

    def _latest(self):
        """The newest entry; every entry lists the whole table, so older ones are not read."""
        entries = self._entries()
        return self.spark.read.schema(_ENTRY_DDL).json(entries[-1]).first() if entries else None

    @property
    def version(self) -> int:
        """Number of the current version, 0 before the first commit."""
        entries = self._entries()
        return int(entries[-1].split("/")[-2].split("~")[0]) if entries else 0

    def has_batch(self, batch: str) -> bool:
        """Whether a commit already carries this batch name."""
        return any(f.split("/")[-2].split("~", 1)[1] == batch for f in self._entries())

    def _load(self, entry, pieces: Sequence | None = None) -> DataFrame:
        """Rows of the entry's pieces, or some of them, under all columns the table ever had."""
        schema = T.StructType.fromJson(json.loads(entry["fields"]))
        folders = [T.StructField(c, T.StringType()) for c in (_ATTEMPT, _PART)]
        reader = self.spark.read.schema(T.StructType([*schema.fields, *folders]))
        paths = [p["path"] for p in (entry["pieces"] if pieces is None else pieces)]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, folders[1]]))
        return reader.option("basePath", self._data).parquet(*paths).drop(_ATTEMPT)

    def read(self, months: Collection[str] | None = None) -> DataFrame | None:
        """The current version, or None before the first commit.

        ``months`` ("2024-01") limits it to the parts that may hold rows of these months.
        """
        latest = self._latest()
        if not latest:
            return None
        pieces = latest["pieces"]
        if months is not None:
            wanted = {f"p{m[:self._digits]}" for m in months} | {"all"}
            pieces = [p for p in pieces if p["part"] in wanted]
        return self._load(latest, pieces).drop(_PART)

    def newest(self) -> DataFrame | None:
        """The rows of the latest month only: where the largest ``dated_by`` is found."""
        latest = self._latest()
        if not latest:
            return None
        dated = [p for p in latest["pieces"] if p["part"] != _UNDATED] or latest["pieces"]
        last = max(p["part"] for p in dated)
        return self._load(latest, [p for p in dated if p["part"] == last]).drop(_PART)

    # ---- writing

    def _part(self) -> Column:
        if self._dated_by is None:
            return F.lit("all")
        period = F.substring(F.col(self._dated_by).cast("string"), 1, self._digits)
        return F.coalesce(F.concat(F.lit("p"), period), F.lit(_UNDATED))

    def _write(self, df: DataFrame, kept: Sequence, batch: str | None, latest) -> int:
        version = (latest["version"] if latest else 0) + 1
        known = T.StructType.fromJson(json.loads(latest["fields"])) if latest else None
        fields = _union(known, df.schema)
        path = f"{self._data}/{_ATTEMPT}={version:012d}-{uuid.uuid4().hex}"
        # Rows of a month meet before the write, so months do not multiply with
        # tasks into small files; AQE splits a large month and joins small ones.
        df = df.withColumn(_PART, self._part()).hint("rebalance", _PART)
        df.write.option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy(_PART).parquet(path)
        # The folder is this attempt's own. At most one row per calendar month.
        written = self.spark.read.schema(df.schema).parquet(path).select(_PART).distinct().collect()
        index = self._index(df, path)
        pieces = [(p["part"], p["path"], p["index"]) for p in kept]
        pieces += [(r[_PART], f"{path}/{_PART}={r[_PART]}", index) for r in written]
        entry = self.spark.createDataFrame([(version, batch, fields.json(), pieces)], _ENTRY_DDL)
        entry.coalesce(1).write.json(f"{self._log}/{version:012d}~{batch or ''}")
        return version

    def _index(self, df: DataFrame, path: str) -> str | None:
        """Write the key index of the pieces just written below ``path``; returns its folder."""
        key = self._indexed_by
        if key is None or key not in df.columns:
            return None
        rows = self.spark.read.schema(df.schema).parquet(path).select(key, _PART)
        folder = f"{self._indexes}/{key}/{path.rsplit('=', 1)[1]}"
        piece = F.concat(F.lit(f"{path}/{_PART}="), F.col("piece"))
        key_index.build(rows, key, _PART).withColumn("piece", piece).write.parquet(folder)
        return folder

    def _openable(self, pieces: Sequence, keys: DataFrame, key: str) -> list:
        """The pieces that may hold one of ``keys``."""
        known = [p for p in pieces if p["index"] and p["index"].startswith(f"{self._indexes}/{key}/")]
        if not known or key != self._indexed_by:
            return list(pieces)
        index = self.spark.read.parquet(*sorted({p["index"] for p in known})).where(
            F.col("piece").isin([p["path"] for p in known]))
        found = key_index.may_hold(index, keys, keys.columns[0])
        sure = {p["path"] for p in known} - set(found)
        return [p for p in pieces if p["path"] not in sure]

    def commit(self, df: DataFrame, batch: str | None = None) -> int:
        """Make ``df`` the whole content of the next version."""
        return self._write(df, [], batch, self._latest())

    def compact(self) -> int:
        """Rewrite the months that are held in more than one piece; returns the current version."""
        latest = self._latest()
        parts = [p["part"] for p in latest["pieces"]]
        many = {p for p in parts if parts.count(p) > 1}
        if not many:
            return latest["version"]
        rows = self._load(latest, [p for p in latest["pieces"] if p["part"] in many]).drop(_PART)
        return self._write(rows, [p for p in latest["pieces"] if p["part"] not in many], None, latest)

    def merge(self, new: DataFrame, key: str, order_by: Sequence[Column], batch: str | None = None,
              keep: str = "new") -> int:
        """Commit the table with ``new`` upserted by ``key``; returns the current version.

        The batch is computed once and written aside. Its keys then find the
        months that hold a replaced row; those are rewritten, and the new rows
        land beside all others. With ``keep="first"`` the first by ``order_by`` of
        the old and the new row stays. Rows without a key are kept once each. An
        unnamed empty batch commits nothing. Files are read in small splits, since a
        task sorts the rows of its split, and what a step shuffles is deleted when it ends.
        """
        with settings(self.spark, small_splits() | freed_shuffles()):
            return self._merge(new, key, order_by, batch, keep)

    def _merge(self, new: DataFrame, key: str, order_by: Sequence[Column], batch: str | None, keep: str) -> int:
        latest = self._latest()
        self.opened = []
        winners = without_repeated_keyless(deduplicate(new, key, order_by), key)
        if latest is None:
            return self._write(winners, [], batch, None)
        _union(T.StructType.fromJson(json.loads(latest["fields"])), new.schema)
        aside = f"{self._incoming}/{uuid.uuid4().hex}"
        winners.write.option("compression", "zstd").parquet(aside)
        winners = self.spark.read.schema(new.schema).parquet(aside)
        if batch is None and winners.isEmpty():
            return latest["version"]
        keys = winners.select(F.col(key).alias("_key")).distinct()
        openable = self._openable(latest["pieces"], keys, key)
        self.opened = [(p["part"], p["path"]) for p in openable]
        # At most one row per calendar month.
        replaced = self._load(latest, openable).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        touched = {r[_PART] for r in replaced.select(_PART).distinct().collect()}
        if touched:
            changed = self._load(latest, [p for p in latest["pieces"] if p["part"] in touched]).drop(_PART)
            if keep == "first":
                winners = first_of_both(changed, winners, key, order_by)
            merged = without_keys(changed, winners, key).unionByName(winners, allowMissingColumns=True)
            winners = without_repeated_keyless(merged, key)
        kept = [p for p in latest["pieces"] if p["part"] not in touched]
        return self._write(winners, kept, batch, latest)

