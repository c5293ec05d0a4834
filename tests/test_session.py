from vigil.session import configure, shared_dir, size_shuffles, stored_bytes


def test_shuffles_grow_with_the_input_and_never_shrink(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10) == int(before)
        assert size_shuffles(spark, 1 << 40) == 24576
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24576"
        assert size_shuffles(spark, 10) == 24576
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sizes_come_from_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    assert 0 < stored_bytes(spark.read.parquet(path)) < 100_000


def test_the_shared_folder_is_the_one_the_session_names(spark, tmp_path_factory):
    assert shared_dir(spark).startswith(str(tmp_path_factory.getbasetemp()))


def test_configure(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
