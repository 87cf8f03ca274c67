"""What steps leave on disk while a job goes on."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone import session


def _shuffled(spark):
    """Names of the shuffle files there are, whoever wrote them."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_shuffles_of_a_step_end_with_it(spark):
    choice = spark.conf.get(session._CLEANUP, None)
    before = _shuffled(spark)
    numbers = spark.range(20_000).select((F.col("id") % 100).alias("k"), "id")
    counted = numbers.repartition(3, "id").groupBy("k").agg(F.count("id").alias("n"))
    assert counted.count() == 100
    seen = _shuffled(spark) - before
    # The count leaves its files until the driver collects its garbage; the frame itself can be used as before.
    kept = session.materialise(counted, "counted")
    assert not _shuffled(spark) - before - seen
    assert kept.agg(F.sum("n")).first()[0] == counted.agg(F.sum("n")).first()[0] == 20_000
    assert spark.conf.get(session._CLEANUP, None) == choice


def test_a_choice_of_the_user_stays(spark):
    choice = spark.conf.get(session._CLEANUP, None)
    try:
        spark.conf.set(session._CLEANUP, "true")
        session.materialise(spark.range(5), "few")
        assert spark.conf.get(session._CLEANUP) == "true"
    finally:
        spark.conf.set(session._CLEANUP, choice or "false")
