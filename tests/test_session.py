from tidewatch.session import checkpoint_root, cluster_conf, parallelism, work_dir


def test_cluster_conf_sizes_for_the_cluster():
    c = cluster_conf(executors=1000, cores_per_executor=4)
    assert c["spark.sql.shuffle.partitions"] == "16000"
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 512 * 1024 * 1024
    assert cluster_conf(state_partitions=400)["spark.sql.shuffle.partitions"] == "400"


def test_work_dirs_live_under_the_shared_root(spark):
    root = checkpoint_root(spark).rstrip("/")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(root + "/tidewatch/x/")
    assert parallelism(spark) >= 1
