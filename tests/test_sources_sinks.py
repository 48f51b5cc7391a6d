"""Quarantine of refused lines and bucketed tables."""
import os

from pyspark.sql import functions as F

from shelfwise.operators import recommend as R
from shelfwise.schemas import RATINGS
from shelfwise.sources import readers as RD
from shelfwise.session import checkpoint_dir, drop_scratch
from shelfwise.sources.sinks import write_bucketed, write_table


def test_every_line_is_good_or_refused(spark, tmp_path):
    lines = ["book_id,user_id,rating", "1,2,5", "3,4", "5,x,1", "6,7,8,9", "8,9,", '"10",11,4', "junk", "12,13,99999999999"]
    (tmp_path / "r.csv").write_text("\n".join(lines) + "\n")
    good, bad = RD.read_lines(spark, str(tmp_path / "r.csv"), RATINGS)
    assert sorted(map(tuple, good.collect()), key=repr) == [(1, 2, 5), (10, 11, 4), (8, 9, None)]
    rows = bad.collect()
    assert sorted(r.line for r in rows) == sorted(["3,4", "5,x,1", "6,7,8,9", "junk", "12,13,99999999999"])
    assert all(r.file.endswith("r.csv") for r in rows) and good.columns == RATINGS.fieldNames()
    good, bad = RD.read_lines(spark, str(tmp_path / "none"), RATINGS)
    assert good.count() == bad.count() == 0


def test_bucketed_sides_need_no_exchange(spark):
    inter = spark.range(2000).select((F.col("id") % 100).alias("user_id"), (F.col("id") % 37).alias("book_id"), F.lit(3).alias("rating"))
    nb = spark.range(200).select((F.col("id") % 37).alias("book_id"), (F.col("id") % 29).alias("other_id"), F.lit(5).cast("long").alias("nano"))
    a, b = write_bucketed(inter, "inter", "book_id", 4), write_bucketed(nb, "nb", "book_id", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = a.join(b, "book_id")._jdf.queryExecution().executedPlan().toString()
        scored = R.score_candidates(a, b)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "hashpartitioning(book_id" not in scored
    want = {(r.user_id, r.book_id): r.score_nano for r in R.score_candidates(inter, nb).collect()}
    assert {(r.user_id, r.book_id): r.score_nano for r in R.score_candidates(a, b).collect()} == want


def test_written_tables_are_dropped_and_nothing_else(spark, tmp_path):
    drop_scratch(spark)
    own = write_table(spark.range(10).toDF("id"), "own", spark)
    other = write_table(spark.range(10).toDF("id"), "other", spark, path=str(tmp_path / "other"))
    assert own.count() == 10 and drop_scratch(spark) == 1
    folder = os.path.join(checkpoint_dir(spark).replace("file:", "", 1), "tables")
    assert not [f for f in os.listdir(folder) if f.startswith("own-")]
    assert other.count() == 10 and drop_scratch(spark) == 0
