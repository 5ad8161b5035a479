"""Tables and files in the folder that all executors share (`spark.checkpoint.dir`)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from spark_recs.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """`df`, written as Parquet to the shared folder and read again: computed
    once, and a lost executor's rows are read from the table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(file system, path) of a URI or an absolute path, for tasks."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
