"""Tables that a plan reads more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def keep(df: DataFrame) -> DataFrame:
    """``df``, cut from its lineage where a checkpoint folder is set, else cached; what reads it twice computes it once."""
    spark = df.sparkSession
    if folder := spark.conf.get("spark.checkpoint.dir", ""):
        spark.sparkContext.setCheckpointDir(folder)
        return df.checkpoint()
    return df.cache()
