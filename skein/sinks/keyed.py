"""Keyed tables with deltas: merge on read, for model state and dictionaries (JN-06, ML-03, INC-01..06, SET-03).

A table is a base and the deltas applied since, each bucketed by the key into the same
number of buckets. A batch writes its own keys only; no earlier file is touched. Reading takes
each key from the newest part that holds it: parts meet bucket by bucket, so neither the read,
nor a lookup, nor a compaction shuffles what is stored. A log of versions below ``root`` names
the parts in force; a version counts once its one file is committed, so a job that dies before
that changes nothing (its part is never read), and a batch applied before is not applied again.

One writer at a time: a version that exists is not overwritten, the second writer fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.config import drop_bucketed, store_bucketed

LOG = "seq long, part string, path string, batch long, v long"
GONE = "__gone"
ROOM_AT = 4


class KeyedTable:
    """Rows ``key + values`` with unique, non-null keys.

    ``buckets``: at least ``spark.sql.shuffle.partitions``, or the planner may prefer to
    shuffle both sides of a join with another table; the default is that setting.
    """

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], schema: str | T.StructType,
                 buckets: int | None = None):
        self.spark, self.root, self.key = spark, root, list(key)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.values = [c for c in self.schema.names if c not in self.key]
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # --- versions ------------------------------------------------------------------
    def _log(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(LOG).parquet(f"{self.root}/log")

    def _parts(self) -> list:
        """The parts in force, oldest first (one short row each)."""
        log = self._log()
        if log is None:
            return []
        newest = log.agg(F.max("v")).first()[0]
        return log.where(F.col("v") == newest).orderBy("seq").collect()

    def _commit(self, v: int, parts: list[dict]) -> None:
        rows = [(p["seq"], p["part"], p["path"], p["batch"]) for p in parts]
        log = self.spark.createDataFrame(rows, "seq long, part string, path string, batch long")
        log.coalesce(1).write.parquet(f"{self.root}/log/v={v}")

    def _table(self, part) -> DataFrame:
        """A stored part; a new session registers its files again under the same name."""
        if not self.spark.catalog.tableExists(part["part"]):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*self.schema.fields, T.StructField(GONE, T.BooleanType())])
            by = ", ".join(f"`{c}`" for c in self.key)
            self.spark.sql(f"CREATE TABLE {part['part']} ({fields}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{part['path']}'")
        return self.spark.table(part["part"])

    # --- writing -------------------------------------------------------------------
    def apply(self, updates: DataFrame, batch: int, gone: DataFrame | None = None) -> bool:
        """Put ``updates`` (one row a key) over what is stored and take the keys ``gone`` out.

        ``batch``: ascending numbers; False, and nothing done, for one that is applied already.
        """
        parts = self._parts()
        if parts and batch <= max(p["batch"] for p in parts):
            return False
        rows = updates.select(*self.schema.names, F.lit(False).alias(GONE))
        if gone is not None:
            empty = [F.lit(None).cast(self.schema[c].dataType).alias(c) for c in self.values]
            rows = rows.unionByName(gone.select(*self.key, *empty, F.lit(True).alias(GONE)))
        self._add(parts, parts, rows, batch, deal=True)
        return True

    def _add(self, parts: list, keep: list, rows: DataFrame, batch: int, deal: bool) -> None:
        """The next version: the parts ``keep`` and above them ``rows`` as a new part."""
        _, name = store_bucketed(rows, "part", self.buckets, self.key, deal)
        path = self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
        seq = parts[-1]["seq"] + 1 if parts else 0
        self._commit(parts[-1]["v"] + 1 if parts else 0,
                     [*(p.asDict() for p in keep), {"seq": seq, "part": name, "path": path, "batch": batch}])

    def compact(self) -> None:
        """Fold all parts into one base, bucket by bucket; gone keys leave the files.

        The older parts stay for their readers until ``expire``.
        """
        parts = self._parts()
        if len(parts) > 1:
            self._add(parts, [], self.read().withColumn(GONE, F.lit(False)), max(p["batch"] for p in parts), deal=False)

    def expire(self) -> None:
        """Delete the parts that the newest version does not name."""
        log = self._log()
        if log is None:
            return
        now = {p["part"] for p in self._parts()}
        for part in log.select("part", "path").distinct().collect():
            p = self.spark._jvm.org.apache.hadoop.fs.Path(part["path"])
            if part["part"] not in now and p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
                self._table(part)
                drop_bucketed(self.spark, part["part"])

    # --- reading -------------------------------------------------------------------
    def _newest_first(self) -> list[DataFrame]:
        return [self._table(p) for p in reversed(self._parts())]

    def read(self) -> DataFrame:
        """Every key with the values of the newest part that holds it, without the gone ones."""
        parts, out = self._newest_first(), []
        for i, df in enumerate(parts):
            for newer in parts[:i]:
                df = df.join(newer.select(*self.key), self.key, "left_anti")
            out.append(df.where(~F.col(GONE)).select(*self.schema.names))
        if not out:
            return self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, out)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``keys`` (any further columns) with the stored values, null where the key is absent.

        Only ``keys`` is shuffled, once: every part is joined in its buckets.
        """
        found = keys
        for i, df in enumerate(self._newest_first()):
            found = found.join(df.select(*self.key, F.struct(GONE, *self.values).alias(f"__p{i}")), self.key, "left")
        hits = [c for c in found.columns if c.startswith("__p")]
        if not hits:
            return keys.select("*", *[F.lit(None).cast(self.schema[c].dataType).alias(c) for c in self.values])
        hit = F.coalesce(*hits)
        return found.select(*keys.columns, *[F.when(~hit[GONE], hit[c]).alias(c) for c in self.values])

    def room(self, at: int = ROOM_AT) -> bool:
        """Compact once the table has ``at`` parts, so that reads stay a few joins; True if it did."""
        due = len(self._parts()) >= at
        if due:
            self.compact()
        return due
