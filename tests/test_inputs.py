from riskstream.catalog.inputs import spread


def test_spread_gives_a_partition_per_rows_per_task(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 40 * cores, numPartitions=1)
    spread_rows = spread(rows, rows_per_task=2)
    assert spread_rows.rdd.getNumPartitions() == 20 * cores
    assert sorted(r.id for r in spread_rows.collect()) == list(range(40 * cores))


def test_spread_leaves_enough_partitions_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 4 * cores, numPartitions=2 * cores)
    assert spread(rows, rows_per_task=4).rdd.getNumPartitions() == 2 * cores


def test_spread_batch_gives_a_partition_per_records_per_task(spark):
    from riskstream.streaming.ingest import spread_batch

    cores = spark.sparkContext.defaultParallelism
    batch = spark.range(0, 30 * cores, numPartitions=1)
    assert spread_batch(batch, records_per_task=3).rdd.getNumPartitions() == 10 * cores
