"""What written tables leave on disk."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from ribolake.operators import staging


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(1 for folder in folders for _ in Path(folder).rglob("shuffle_*.data"))


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(10_000, numPartitions=4).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("n"))
    table = staging.stage(rows.repartition(3, "n"), "shuffled")
    # Spark deletes them beside the driver's next step.
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert table.count() == 100 and table.agg(F.sum("n")).first()[0] == 10_000 * 9_999 // 2
    assert spark.conf.get(staging.CLEANUP, None) in (None, "false")
    # The same plan can still be run.
    assert rows.count() == 100
