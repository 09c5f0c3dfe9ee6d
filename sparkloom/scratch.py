"""Tables staged in the folder that spark.checkpoint.dir names, to cut lineage in loops."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get().rstrip("/")
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


class Staged:
    """A table written once and read back. ``drop`` deletes it; else it goes with the driver's JVM."""

    def __init__(self, df: DataFrame, tag: str):
        spark = df.sparkSession
        where = f"{scratch_dir(spark)}/stage-{tag}-{uuid.uuid4().hex}"
        df.write.parquet(where)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(self._path)
        self.df = spark.read.schema(df.schema).parquet(where)

    def drop(self) -> None:
        self._fs.delete(self._path, True)
