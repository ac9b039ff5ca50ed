"""What a written stage leaves on disk."""

from pyspark.sql import functions as F

from stratamart.session import stage


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return found.mkString("\n").count("/shuffle_")


def test_a_written_stage_leaves_no_shuffle_files(spark):
    """F3 to F7: a chain of written tables does not hold the shuffles of all its steps at once."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = shuffle_files(spark), spark.conf.get(setting)
    rows = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.sum("id").alias("s"))
    staged = stage(rows, "shuffled")
    assert shuffle_files(spark) <= before and spark.conf.get(setting) == conf
    assert staged.count() == rows.count() == 5000  # the frame itself can still be run
