from cartwheel.session import SETTINGS, prepare, shared_dir, staged


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_staging_cuts_the_plan(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    again = staged(df, "t")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and again.count() == 10 and again.dtypes == df.dtypes


def test_prepare_applies_every_setting(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    prepare(spark)
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())
