from toolgauge.operators import scoring
from toolgauge.plans import inputs
from toolgauge.streaming.scoring import score_stream

SF_DIR = "/root/testdata/sf0.001"


def test_stream_scores_like_batch(spark, tmp_path):
    examples, predictions = inputs.eval_examples(spark, SF_DIR), inputs.predictions(spark, SF_DIR)
    source = str(tmp_path / "predictions")
    predictions.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(predictions.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        score_stream(stream, examples)
        .select("ord", "error_type")
        .writeStream.format("memory")
        .queryName("scored_stream")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    batch = scoring.score_calls(scoring.with_predictions(examples, predictions))
    got = sorted(tuple(r) for r in spark.table("scored_stream").collect())
    assert got == sorted(tuple(r) for r in batch.select("ord", "error_type").collect())
