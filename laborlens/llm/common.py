"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import laborlens
from laborlens.session import ensure_checkpoint_dir, table_path

#: white space of every word and line rule here: the six ASCII characters
ASCII_SPACE = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder, and this package on the workers' path.

    The package travels as one small zip through Spark's own file server, so
    executors need no installation, and functions are imported there (their
    module-level caches live as long as the worker process)."""
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if getattr(sc, "_laborlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(laborlens.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="laborlens-zip-"), "laborlens_package.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("laborlens", os.path.relpath(p, root)))
    sc.addPyFile(out)
    sc._laborlens_shipped = True


def shared(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder, as a URI."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/laborlens-llm/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once,
    lineage cut, nothing held by one executor alone."""
    spark = df.sparkSession
    path = shared(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_bucketed(df: DataFrame, name: str, buckets: int, col: str, sort: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder as a table bucketed (and ``sort``: sorted) by ``col``; later
    joins and cogroups on ``col`` read it without another shuffle. The session's warehouse is
    not written, so it need be neither shared nor writable."""
    spark = df.sparkSession
    table = f"laborlens_{name}_{uuid.uuid4().hex[:12]}"
    writer = (df.write.option("compression", "zstd").option("path", shared(spark, name)).format("parquet")
              .bucketBy(buckets, col))
    (writer.sortBy(col) if sort else writer).saveAsTable(table)
    return spark.table(table)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count: what the cluster sets to follow its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) of a URI as Hadoop writes it."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def read_bytes(fsys, path: str) -> bytes:
    with fsys.open_input_file(path) as f:
        return f.read()


def write_bytes(fsys, path: str, data: bytes) -> None:
    with fsys.open_output_stream(path) as f:
        f.write(data)


__all__ = ["ASCII_SPACE", "filesystem", "keep", "keep_bucketed", "load", "partitions", "prepare",
           "read_bytes", "shared", "text_or_empty", "write_bytes"]
