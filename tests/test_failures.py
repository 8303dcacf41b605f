"""A publishing write survives a lost task: the task is re-run and the
table holds every row exactly once. Local mode retries tasks only with
``local[N,F]``, so this runs in its own process and session."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from strata.session import scratch_path
    from strata.sinks import write_table

    spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())

    @F.udf(T.StringType())
    def fails_once(k):  # test-only: the first attempt of partition 0 dies
        tc = TaskContext.get()
        if tc.partitionId() == 0 and tc.attemptNumber() == 0:
            raise RuntimeError("simulated executor loss")
        return k

    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 10).cast("string").alias("user_id"), "id")
    df = df.withColumn("user_id", fails_once("user_id"))
    path = scratch_path(spark, "t-lost-task")
    n = write_table(df, path, partition_by=["user_id"])
    back = spark.read.parquet(path)
    print("RESULT", n, back.count(), back.select("id").distinct().count())
    """
)


def test_partitioned_write_survives_a_lost_task():
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT)],
        capture_output=True,
        text=True,
        timeout=600,
    )
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert lines, out.stderr[-2000:]
    assert lines[0].split()[1:] == ["1000", "1000", "1000"]
    assert "simulated executor loss" in out.stderr  # the failure did happen
