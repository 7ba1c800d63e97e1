"""Session helpers: a local session for tests and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of a join side that is broadcast; every executor holds one copy.
BROADCAST_BYTES = 32 << 20
#: Paths written within the open scopes of :func:`scratch`, innermost last.
_SCOPES: list[list[str]] = []


def local_session(app: str = "basinspark", cores: str = "8", **settings: str) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the caller passes a session of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    It is only chosen here when the session names none, and then only for a local master.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local($|\[)", context.master):
                raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
            folder = tempfile.mkdtemp(prefix="basinspark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder, deleted at the end of the innermost open :func:`scratch`."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Within this scope written intermediate tables are collected, and deleted when it ends.

    A result that is still to be read must be computed inside. Without a scope the tables stay until their owner clears
    the shared folder, as a data frame may be read at any later time.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        delete_paths(spark, paths)


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files and folders, in whatever store they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def persisted(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a table in the shared folder, so that later jobs see one fixed set of rows.

    A written table computes its rows once and keeps column pruning and size statistics, which an RDD checkpoint does
    not. The rows are computed when this is called, not when the result is read.
    """
    path = fresh_folder(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_checked(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A join side that is broadcast if its values take at most ``most_bytes``, and joined by a shuffle otherwise.

    The side is written first, so that measuring does not compute it a second time.
    """
    return broadcast_if_small(persisted(df), most_bytes)


def broadcast_if_small(side: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """As :func:`size_checked`, for a side that is a written table already.

    A value of fixed width counts 8 bytes and a row 16 more; texts and nested values count with their length.
    """
    width = 16 + 8 * len(side.columns)
    rows = side.count()  # from the footers of the written files
    if rows * width > most_bytes:
        return side
    long = [f for f in side.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    texts = [F.octet_length(f"`{f.name}`" if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(f"`{f.name}`"))) for f in long]
    extra = side.agg(F.sum(sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0).cast("long")))).first()[0] if texts else 0
    return F.broadcast(side) if rows * width + (extra or 0) <= most_bytes else side
