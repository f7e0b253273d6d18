"""Scoring a stream of new reviews with a fitted model.

Each micro-batch is a static DataFrame, so ``foreachBatch`` runs the same batch plan
(words -> buckets -> TF-IDF with the fitted IDF -> model) on it and writes the predictions to a
folder of the batch's own, overwriting it: a restarted query re-runs an unfinished batch and
leaves no row twice. Scoring reads a saved model, so no batch fits anything again.

A model may have versions: ``publish`` saves the next one beside the others and names it last, and a
running query takes it up with its next batch. ``ModelCache`` keeps the tables of the version in use
in memory, so a batch lists one folder and loads nothing while the version stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from revlens.operators.bayes import NaiveBayesModel
from revlens.plans.pipeline import WORDS, Scorer, Tokenizer, score_texts


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def latest_version(spark: SparkSession, model_path: str) -> int:
    """The newest published version under ``model_path``; 0 if there is none."""
    files, at = _path(spark, f"{model_path}/versions")
    if not files.exists(at):
        return 0
    return max((int(f.getPath().getName()) for f in files.listStatus(at)), default=0)


def publish(model: Scorer, model_path: str) -> int:
    """Save ``model`` as the next version under ``model_path`` and return its number. Its name is written
    last, so a version is seen when all of its tables are there; publish from one place at a time."""
    spark = model.idf.sparkSession
    version = latest_version(spark, model_path) + 1
    model.save(f"{model_path}/version={version}")
    files, at = _path(spark, f"{model_path}/versions/{version}")
    files.mkdirs(at)
    return version


class ModelCache:
    """The newest version of a model with its tables cached, loaded again only when that changes.

    ``loads`` counts the loads. A path without versions is taken as one model as ``Scorer.save`` writes
    it, loaded once. A batch is scored by one version from start to end.
    """

    def __init__(self, model_path: str):
        self.model_path, self.version, self.model, self.loads = model_path, None, None, 0

    def get(self, spark: SparkSession) -> Scorer:
        version = latest_version(spark, self.model_path)
        if version != self.version:
            self.drop()
            self.model = Scorer.load(spark, f"{self.model_path}/version={version}" if version else self.model_path)
            for table in self._tables():
                table.cache()
            self.version, self.loads = version, self.loads + 1
        return self.model

    def drop(self) -> None:
        """Free the cached tables."""
        for table in self._tables():
            table.unpersist()
        self.version = self.model = None

    def _tables(self) -> list[DataFrame]:
        if self.model is None:
            return []
        model = self.model.model
        return [self.model.idf, model.weights, *([model.priors] if isinstance(model, NaiveBayesModel) else [])]


def score_stream(reviews: DataFrame, model_path: str, key: str,
                 out_path: str, checkpoint_location: str, text_col: str = "text",
                 available_now: bool = True, tokenizer: Tokenizer = WORDS,
                 cache: ModelCache | None = None) -> StreamingQuery:
    """Start a query writing ``(key, prediction)`` rows for every review that arrives, under
    ``out_path/batch=<id>``, by the newest version of the model at ``model_path``."""
    cache = cache or ModelCache(model_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        pred = score_texts(cache.get(batch.sparkSession), batch.select(key, text_col), key=key, text_col=text_col, tokenizer=tokenizer)
        pred.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    writer = (reviews.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
