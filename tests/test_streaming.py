"""Structured Streaming rebuild: a second availableNow run on the same checkpoint
processes only the change files that arrived after the first."""

from pyspark.sql import functions as F

from docmart.streaming.incremental import DocumentSinks, start_document_stream

from .test_changes import _catalog


def test_two_runs_one_checkpoint(spark, scratch):
    cat = _catalog(spark)
    feed = f"{scratch}/feed"
    schema = "source string, id string"
    spark.createDataFrame([("film_work", "f2")], schema).coalesce(1).write.mode("append").parquet(feed)
    sinks = DocumentSinks(f"{scratch}/idx")
    ckpt = f"{scratch}/ckpt"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
        start_document_stream(spark, stream, lambda: cat, sinks, ckpt, {"availableNow": True}).awaitTermination()

    run()
    movies = spark.read.parquet(sinks.path("movies"))
    assert [(r.id, r.batch_id) for r in movies.collect()] == [("f2", 0)]
    spark.createDataFrame([("genre", "g1")], schema).coalesce(1).write.mode("append").parquet(feed)
    run()
    movies = spark.read.parquet(sinks.path("movies"))
    assert sorted((r.id, r.batch_id) for r in movies.collect()) == [("f1", 1), ("f2", 0)]
    genres = spark.read.parquet(sinks.path("genres"))
    assert [(r.id, r.batch_id) for r in genres.where(F.col("batch_id") == 1).collect()] == [("g1", 1)]
