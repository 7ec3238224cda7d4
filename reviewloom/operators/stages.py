"""The text step and both models as Spark ML stages with the standard writers and readers.

A ``Pipeline`` of these fits to a ``PipelineModel`` that any Spark ML program can save,
load and apply: ``PipelineModel.load(path).transform(reviews)``.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions import text as X
from reviewloom.operators import sentiment, topics


class _FittedWriter(MLWriter):
    """Params and metadata as usual, the fitted tables in a folder beside them."""

    def __init__(self, stage: _FittedStage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.save_fitted(self.sparkSession, f"{path}/fitted")


class _FittedReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _FittedStage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind(self.kind.load_fitted(self.sparkSession, f"{path}/fitted"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _FittedStage(Model, HasInputCol, MLWritable, MLReadable):
    """A model held as small tables; ``fitted`` is None only while Spark copies a stage."""

    def __init__(self, fitted=None):
        super().__init__()
        self._setDefault(inputCol="classical_text")
        self.fitted = fitted

    def copy(self, extra=None):
        other = super().copy(extra)
        other.fitted = self.fitted
        return other

    def write(self) -> MLWriter:
        return _FittedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FittedReader(cls)


class ClassicalText(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Cleaned, stop-word-free, lemmatised text; row-local."""

    @keyword_only
    def __init__(self, *, inputCol: str = "review_text", outputCol: str = "classical_text"):
        super().__init__()
        self._setDefault(inputCol="review_text", outputCol="classical_text")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), X.classical_text(F.col(self.getInputCol())))


class SentimentClassifierModel(_FittedStage):
    """Adds label, probabilities and confidence."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sentiment.predict(dataset, self.fitted, self.getInputCol())

    def save_fitted(self, spark: SparkSession, path: str) -> None:
        sentiment.save_model(spark, self.fitted, path)

    @staticmethod
    def load_fitted(spark: SparkSession, path: str) -> sentiment.SentimentModel:
        return sentiment.load_model(spark, path)


class SentimentClassifier(
    Estimator, HasInputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable
):
    """TF-IDF with a multinomial logistic regression."""

    keyCol = Param(Params._dummy(), "keyCol", "column that names a row", TypeConverters.toString)
    c = Param(Params._dummy(), "c", "inverse strength of the L2 penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most iterations", TypeConverters.toInt)
    balanced = Param(Params._dummy(), "balanced", "weigh labels alike", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str = "classical_text",
        labelCol: str = "sentiment_label",
        keyCol: str = "review_id",
        c: float = 1.0,
        maxIter: int = 1000,
        balanced: bool = True,
    ):
        super().__init__()
        self._setDefault(
            inputCol="classical_text",
            labelCol="sentiment_label",
            keyCol="review_id",
            c=1.0,
            maxIter=1000,
            balanced=True,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SentimentClassifierModel:
        fitted = sentiment.train_classifier(
            dataset,
            self.getInputCol(),
            self.getLabelCol(),
            self.getOrDefault(self.keyCol),
            c=self.getOrDefault(self.c),
            max_iter=self.getOrDefault(self.maxIter),
            balanced=self.getOrDefault(self.balanced),
        )
        return SentimentClassifierModel(fitted)._set(inputCol=self.getInputCol())


class TopicFinderModel(_FittedStage):
    """Adds cluster, distance to its centroid and, when named, the topic name."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return topics.predict_topics(dataset, self.fitted, self.getInputCol())

    def save_fitted(self, spark: SparkSession, path: str) -> None:
        from reviewloom.sources.models import save_topic_model

        save_topic_model(spark, self.fitted, path)

    @staticmethod
    def load_fitted(spark: SparkSession, path: str) -> topics.TopicModel:
        from reviewloom.sources.models import load_topic_model

        return load_topic_model(spark, path)


class TopicFinder(Estimator, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """TF-IDF, truncated SVD and K-Means."""

    keyCol = Param(Params._dummy(), "keyCol", "column that names a row", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "number of clusters", TypeConverters.toInt)
    components = Param(Params._dummy(), "components", "rank of the projection", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the starts", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol: str = "classical_text",
        keyCol: str = "review_id",
        k: int = S.N_CLUSTERS,
        components: int = S.SVD_COMPONENTS,
        seed: int = S.RANDOM_SEED,
    ):
        super().__init__()
        self._setDefault(
            inputCol="classical_text",
            keyCol="review_id",
            k=S.N_CLUSTERS,
            components=S.SVD_COMPONENTS,
            seed=S.RANDOM_SEED,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TopicFinderModel:
        model, assigned = topics.fit_topic_model(
            dataset,
            self.getOrDefault(self.k),
            self.getInputCol(),
            self.getOrDefault(self.components),
            seed=self.getOrDefault(self.seed),
            key=self.getOrDefault(self.keyCol),
        )
        topics.release(assigned)
        return TopicFinderModel(model)._set(inputCol=self.getInputCol())


def sentiment_pipeline(text: str = "review_text", **params) -> Pipeline:
    """Text step and classifier; fit it on labelled reviews."""
    return Pipeline(stages=[ClassicalText(inputCol=text), SentimentClassifier(**params)])


def topic_pipeline(text: str = "review_text", **params) -> Pipeline:
    """Text step and topic model; fit it on reviews."""
    return Pipeline(stages=[ClassicalText(inputCol=text), TopicFinder(**params)])
