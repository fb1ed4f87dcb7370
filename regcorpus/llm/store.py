"""Written intermediates: cut lineage with a table in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from regcorpus.session import ensure_checkpoint_dir


TABLES: list[str] = []      # paths of the tables written, oldest first


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder of
    ``spark.checkpoint.dir`` and read it back.

    A lost executor then costs the tasks that run at that moment only, and
    several consumers read the table instead of repeating the work."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    TABLES.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark, since: int, but: int = 1) -> None:
    """Remove the tables that ``written`` made after the first ``since``, all but
    the newest ``but``: the intermediates of a finished stage and what it read.
    Only paths of this process's own tables are touched."""
    gone = TABLES[since:len(TABLES) - but]
    for path in gone:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    TABLES[since:] = TABLES[since + len(gone):]


BATCH_BYTES = 8 << 20


def in_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with Arrow batches bounded by bytes as well as by rows: a
    task holds a batch twice (in the JVM and in Python) besides its work."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)
