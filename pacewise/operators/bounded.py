"""Cut lineage in shared storage."""

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpointed(df: DataFrame, folder: str) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``; ``folder`` is used only where none is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or folder)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else one in the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, of known size; lineage ends there. Clear the folder like one of checkpoints."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with_count(df: DataFrame, name: str, open_rows: Column) -> tuple[DataFrame, int]:
    """As :func:`stored`, with the number of rows for which ``open_rows`` holds, which the write itself counts."""
    seen = Observation(name)
    table = stored(df.observe(seen, F.count_if(open_rows).alias("n")), name)
    return table, seen.get["n"]
