"""Landed pages: what a range opens, what a stream reads again, and that neither loses rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tenderlake.sources import pages

DAY0 = date(2020, 1, 1)


@pytest.fixture
def folder(spark, tmp_path):
    pages.register(spark)
    return f"file://{tmp_path}/landed"


def rows(spark, days, tag=""):
    return spark.createDataFrame([(None if d is None else DAY0 + timedelta(d), f"{tag}{d}") for d in days], "day date, content string")


def test_a_range_opens_its_own_pages_only(spark, folder):
    assert pages.land(rows(spark, [*range(200), None, None]), folder, 10) == 1
    every = spark.read.format("dated_pages").load(folder)
    assert every.count() == 202 and every.where("day IS NULL").count() == 2
    some = every.where((F.col("day") >= F.lit(DAY0 + timedelta(35))) & (F.col("day") < F.lit(DAY0 + timedelta(61))))
    assert sorted(x.content for x in some.collect()) == sorted(map(str, range(35, 61)))
    meeting = [x for x in pages.index(folder) if x.get("first") and x["last"] >= str(DAY0 + timedelta(35)) and x["first"] <= str(DAY0 + timedelta(60))]
    assert len(meeting) <= 5 and some.select("day").rdd.getNumPartitions() == len(meeting) < len(pages.index(folder))
    one = every.where(F.col("day") == F.lit(DAY0 + timedelta(7)))
    assert one.count() == 1 and one.rdd.getNumPartitions() == 1
    assert every.where(F.col("day") > F.lit(date(2030, 1, 1))).count() == 0


def test_filters_narrow_the_range_and_all_stay_for_spark(folder):
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, LessThan

    reader = pages.DatedReader(folder)
    filters = [IsNotNull(("day",)), GreaterThan(("day",), date(2020, 3, 1)), LessThan(("day",), date(2020, 4, 1)), EqualTo(("page",), "x")]
    assert list(reader.pushFilters(filters)) == filters
    assert (reader.first, reader.last) == ("2020-03-02", "2020-03-31")


def follow(spark, folder, out, checkpoint, fail_at=None):
    def keep(batch, number):
        if number == fail_at:
            raise RuntimeError("cut off")
        batch.select("content").withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/{number}")

    stream = spark.readStream.format("dated_pages").option("overlap", "10").load(folder)
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_a_stream_reads_the_overlap_again_and_resumes(spark, folder, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    pages.land(rows(spark, range(30)), folder, 5)
    follow(spark, folder, out, checkpoint)
    # late rows within the overlap and before it, and new days
    pages.land(rows(spark, [3, 25, 30, 31], "late "), folder, 5)
    with pytest.raises(Exception, match="cut off"):
        follow(spark, folder, out, checkpoint, fail_at=1)
    follow(spark, folder, out, checkpoint)
    read = {n: sorted(x.content for x in spark.read.parquet(f"{out}/{n}").collect()) for n in (0, 1)}
    assert read[0] == sorted(map(str, range(30)))
    assert read[1] == sorted([*map(str, range(19, 30)), "late 25", "late 30", "late 31"])
    # what is older than the overlap is for a backfill by range
    old = spark.read.format("dated_pages").load(folder).where(F.col("day") < F.lit(DAY0 + timedelta(19)))
    assert "late 3" in {x.content for x in old.collect()}
    follow(spark, folder, out, checkpoint)  # nothing has landed: no batch
    assert not (tmp_path / "out" / "2").exists()


def test_an_empty_landing(spark, folder):
    assert pages.land(rows(spark, []), folder) == 1
    assert pages.index(folder) == [] and spark.read.format("dated_pages").load(folder).count() == 0
