"""What several operators need: scratch tables, held-out rows, document keys."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CLEANUP = "spark.sql.shuffleDependency.fileCleanup.enabled"
#: A word is a run of code points other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="farebox-")


class Scratch:
    """Tables of one run, in a new folder below ``spark.checkpoint.dir``.

    A written table cuts the lineage and survives lost executors. A session on one
    machine that names no shared folder gets a temporary one; on a cluster that is an error.
    """

    def __init__(self, spark: SparkSession, label: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            root = _own_folder()
        self.spark = spark
        self.folder = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write and reread ``df``; shuffle files of the writing job go at its end."""
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def row_key(*names: str) -> Column:
    """Equal for equal rows only: 64 bits over the columns and which of them are null."""
    return F.xxhash64(*names, *[F.isnull(n) for n in names])


def parts_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
