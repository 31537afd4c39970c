from vellum.session import cluster_conf, scratch_path, shared_dir


def test_shared_folder_comes_from_the_session(spark):
    base = shared_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.replace("file:", ""))


def test_cluster_profile():
    c = cluster_conf(1000, 4)
    assert c["spark.sql.adaptive.enabled"] == "true" and c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(c["spark.sql.shuffle.partitions"]) == 12000
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20
