"""Intermediate tables in the folder that the driver and all executors share."""

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one of our own.

    The own folder lies in the warehouse, except in local mode (tests), where a temporary
    folder is as shared as any other.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        named = "file://" + tempfile.mkdtemp(prefix="modlake-shared-")
    else:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/modlake/{name}-{uuid.uuid4().hex}"


#: Folders of the tables that this process has written and not dropped, oldest first.
_written: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back: lineage ends there.

    A lost executor costs nothing of what was written, unlike a cached or local copy. The table stays
    until dropped() or drop_paths(): a lazy result may still read it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _written.remove(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that stored() has written, once nothing will read them again."""
    for t in tables:
        if t.stored_at in _written:
            _delete(t.sparkSession, t.stored_at)


@contextmanager
def written_since() -> Iterator[list[str]]:
    """A list of the tables written within that are still there when it ends, for drop_paths()."""
    before, paths = set(_written), []
    yield paths
    paths += [p for p in _written if p not in before]


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing will read again: what was made of them has been written or consumed."""
    for path in paths:
        if path in _written:
            _delete(spark, path)


def free_name(name: str, columns) -> str:
    """The name, or if a column has it (case aside) the name with underscores after it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_size(df: DataFrame, col: str = "text") -> tuple[int, int]:
    """Rows and bytes of text: one aggregate row, from which numbers of blocks are worked out."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(col)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def parts_for(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))
