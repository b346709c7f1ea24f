"""Tables that cut a lineage, kept in the folder shared by all executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from logrisk.sources.readers import read_table
from logrisk.sources.writers import write_table

_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are folders that all executors share; Hadoop resolves the path, in every mode alike.
    The path is removed when the session's JVM ends.
    """
    folder = spark.conf.get(_SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    owned = f"{folder.rstrip('/')}/logrisk/{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(owned)
    files = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(jvm_path)
    files.deleteOnExit(jvm_path)
    return f"{owned}/table"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later actions start from the table."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path)
