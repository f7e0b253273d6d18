"""Scoring a stream of reviews gives the same predictions as the batch plan."""

import os
from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SF_SMALL
from revlens.plans.pipeline import Scorer, experiment, fit_naive_bayes, score_texts, scorer
from revlens.streaming.score import ModelCache, latest_version, publish, score_stream


def test_stream_scoring_equals_batch(spark, tmp_dir):
    e = experiment(spark, SF_SMALL, "binary_drop4")
    model = os.path.join(tmp_dir, "model")
    scorer(e, fit_naive_bayes(e)).save(model)
    conv = spark.read.parquet(os.path.join(SF_SMALL, "conversations.parquet"))
    schema = conv.schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "conversations.parquet")
              .parquet(SF_SMALL)
              .select(F.concat_ws(":", "conv_id", "turn").alias("rid"), "text"))
    out = os.path.join(tmp_dir, "pred")
    q = score_stream(stream, model, "rid", out, os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    got = {(r.rid, r.prediction) for r in spark.read.parquet(out).collect()}
    batch = score_texts(Scorer.load(spark, model), conv.select(F.concat_ws(":", "conv_id", "turn").alias("rid"),
                                              "text"), key="rid")
    want = {(r.rid, r.prediction) for r in batch.collect()}
    assert got == want and len(got) == conv.count()
    # a batch that runs again replaces its rows
    import shutil
    commits = os.path.join(tmp_dir, "ckpt", "commits")
    for name in os.listdir(commits):
        os.remove(os.path.join(commits, name))
    score_stream(stream, model, "rid", out, os.path.join(tmp_dir, "ckpt")).awaitTermination(300)
    assert spark.read.parquet(out).count() == conv.count()
    shutil.rmtree(tmp_dir, ignore_errors=True)


def test_a_model_is_swapped_while_the_stream_runs(spark, tmp_dir):
    e = experiment(spark, SF_SMALL, "binary_drop4")
    first = scorer(e, fit_naive_bayes(e))
    turned = (1 - F.col("label")).alias("label")  # the same model with its two classes exchanged
    second = replace(first, model=replace(
        first.model, priors=first.model.priors.withColumn("label", turned),
        weights=first.model.weights.withColumn("label", turned)))
    path, source = os.path.join(tmp_dir, "versions-of-model"), os.path.join(tmp_dir, "in")
    assert latest_version(spark, path) == 0 and publish(first, path) == 1
    conv = spark.read.parquet(os.path.join(SF_SMALL, "conversations.parquet")).select(
        F.concat_ws(":", "conv_id", "turn").alias("rid"), "text")
    parts = [conv.filter(F.pmod(F.xxhash64("rid"), F.lit(3)) == k) for k in range(3)]
    os.makedirs(source)
    cache = ModelCache(path)
    query = score_stream(spark.readStream.schema(conv.schema).parquet(f"{source}/*"), path, "rid",
                         os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "state"), available_now=False, cache=cache)
    try:
        loads = []
        for k, part in enumerate(parts):
            if k == 2:
                assert publish(second, path) == 2
            part.coalesce(1).write.parquet(f"{source}/{k}")
            query.processAllAvailable()
            loads.append((cache.version, cache.loads))
    finally:
        query.stop()
    assert loads == [(1, 1), (1, 1), (2, 2)]
    got = {r.rid: r.prediction for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect()}
    want = {}
    for k, part in enumerate(parts):
        want.update((r.rid, r.prediction) for r in score_texts(second if k == 2 else first, part, key="rid").collect())
    assert got == want and len(got) == conv.count()
    cache.drop()
