"""Streams that ingest what is new."""

from pyspark.sql import functions as F

from wattline.streaming.ingest import append_new_files, daily_totals


def test_new_files_only_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(10).select("id", F.timestamp_seconds(F.col("id") * 86400 + 1_704_067_200).alias("ts"))
    for part in (rows.where("id < 5"), rows.where("id >= 5")):
        part.coalesce(1).write.mode("append").parquet(source)
        append_new_files(spark, source, target, state, rows.schema).awaitTermination(60)
    append_new_files(spark, source, target, state, rows.schema).awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(10))


def test_daily_totals(spark, tmp_path):
    rows = spark.range(48).select(F.timestamp_seconds(F.col("id") * 3600 + 1_704_067_200).alias("ts"), F.lit(2.0).alias("v"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        daily_totals(stream, "ts", "v").writeStream.format("memory").queryName("totals").outputMode("complete")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.awaitTermination(60)
    got = spark.sql("select * from totals order by date").collect()
    assert [(r.n_intervals, r.total) for r in got] == [(24, 48.0), (24, 48.0)]
