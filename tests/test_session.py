from ledgerline.session import scale_conf, shared_dir


def test_scale_conf_sizes_partitions():
    big = scale_conf(100 * 1024**4, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))
    assert scale_conf(100 * 1024**4, 8000, max_shuffle_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    small = scale_conf(10 * 1024**2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_shared_dir_uses_the_session_setting(spark):
    path = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == path
