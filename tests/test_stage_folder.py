"""Commits of stage tables, and runs that are taken up again."""

import os

import pytest
from pyspark.sql import functions as F

from docengine.plans import inputs as I
from docengine.plans.queries import stage_tables
from docengine.plans.stages import run_stages
from docengine.sources.stages import MARK, StageFolder

SF = "/root/testdata/sf0.001"


def failing(df):
    """The frame with a last row that can't be computed."""
    return df.withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))


def test_a_stage_that_dies_leaves_the_one_before(spark, tmp_path):
    stages = StageFolder(spark, str(tmp_path))
    assert stages.committed("st") is None
    first = stages.write(spark.range(5).toDF("id"), "st")
    with pytest.raises(Exception):
        stages.write(failing(spark.range(5).toDF("id")), "st")
    assert stages.committed("st").count() == 5 and first.count() == 5
    # All files are there, but the commit never came.
    spark.range(9).toDF("id").write.parquet(str(tmp_path / "st" / "000007-dead"))
    assert stages.committed("st").count() == 5


def test_the_version_before_stays_readable_and_older_ones_go(spark, tmp_path):
    stages = StageFolder(spark, str(tmp_path))
    spark.range(9).toDF("id").write.parquet(str(tmp_path / "st" / "000003-dead"))
    tables = [stages.write(spark.range(n).toDF("id"), "st") for n in (1, 2, 3)]
    assert tables[1].count() == 2 and stages.committed("st").count() == 3
    versions = sorted(os.listdir(tmp_path / "st"))
    assert [v.partition("-")[0] for v in versions] == ["000005", "000006"]
    assert all(os.path.exists(tmp_path / "st" / v / MARK) for v in versions)


def test_a_run_takes_what_it_has_committed(spark, tmp_path):
    rows = spark.range(3).select("id", F.lit("x").alias("t"))
    assert StageFolder(spark, str(tmp_path), "monday").once(rows, "st").count() == 3
    again = StageFolder(spark, str(tmp_path), "monday").once(failing(spark.range(5).toDF("id")), "st")
    assert again.count() == 3 and again.dtypes == rows.dtypes
    # Another run, or none, writes anew.
    assert StageFolder(spark, str(tmp_path), "tuesday").once(spark.range(4).toDF("id"), "st").count() == 4
    assert StageFolder(spark, str(tmp_path)).once(spark.range(6).toDF("id"), "st").count() == 6
    assert StageFolder(spark, str(tmp_path)).committed("st", "monday") is None


def test_empty_tables_and_odd_columns_are_committed(spark, tmp_path):
    stages = StageFolder(spark, str(tmp_path))
    df = spark.createDataFrame([], "`a b` string, `x.y` array<struct<k:int>>, n int")
    with pytest.raises(Exception):
        stages.committed("none").count()
    out = stages.write(df.withColumnRenamed("a b", "ab").withColumnRenamed("x.y", "xy"), "st")
    assert out.count() == 0 and out.dtypes == stages.committed("st").dtypes


def test_a_chain_that_dies_goes_on_at_its_first_open_stage(spark, tmp_path):
    """The stages that were committed are not computed again, and the outcome is the same."""
    expected = stage_tables(spark, SF, str(tmp_path / "whole"))["showcase"].collect()
    folder = str(tmp_path / "run")
    species = I.species_rows(spark, SF)

    def chain(law_pages, answer_summaries):
        return run_stages(
            law_pages, I.name_index(species), I.profile_pages(species), I.search_results(species),
            I.reports(spark, SF), I.answer_sections, answer_summaries, folder, I.LAW_SECTIONS,
            run="r1",
        )

    def lost(requests, texts):
        return I.answer_summaries(requests, texts).withColumn(
            "response", F.raise_error(F.lit("service is down"))
        )

    with pytest.raises(Exception):
        chain(I.law_pages(spark, SF), lost)
    committed = StageFolder(spark, folder, "r1")
    assert committed.committed("summary_requests", "r1") is not None
    assert committed.committed("st8", "r1") is None
    before = {v for v in os.listdir(f"{folder}/st1")}
    # The pages can't be read any more; only the open stages run.
    pages = I.law_pages(spark, SF).withColumn("html", F.raise_error(F.lit("read again")))
    out = chain(pages, I.answer_summaries)["showcase"].collect()
    assert sorted(map(str, out)) == sorted(map(str, expected))
    assert set(os.listdir(f"{folder}/st1")) == before
