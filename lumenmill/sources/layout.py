"""How a table's rows lie over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(table: DataFrame) -> DataFrame:
    """A table of fewer files than cores, and no more bytes than the cores read at once, is dealt out evenly.

    A Parquet row group is read by one task, so a small file would keep all per-row work on one core. A larger table stays as it is: its
    own splits keep all cores busy, and it is not shuffled for this. The rows are the same either way."""
    spark = table.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    plan = table._jdf.queryExecution().optimizedPlan()
    if int(str(plan.stats().sizeInBytes())) > cores * split or len(table.inputFiles()) >= cores:
        return table
    return table.repartition(cores)
