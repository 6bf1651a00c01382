from landfall.session import scratch_dir, shared_dir


def test_scratch_lives_under_the_sessions_shared_folder(spark):
    base = shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        assert base == configured.rstrip("/")
    else:
        assert spark.sparkContext.getCheckpointDir() is not None
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(base + "/landfall/x-") and a != b
