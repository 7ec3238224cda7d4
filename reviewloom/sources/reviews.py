"""The clustered review table: loaded once, normalised, checked and cached."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators import insights as I
from reviewloom.operators.cleaning import raise_on_violations


class ReviewStore:
    """Read-only access to one clustered review table."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", sentiment: str = "predicted_sentiment"):
        self.spark, self.path, self.fmt, self.sentiment = spark, path, fmt, sentiment
        self._reviews: DataFrame | None = None

    def load(self, refresh: bool = False) -> DataFrame:
        """The cached table; ``refresh`` drops the cache and reads again."""
        if self._reviews is not None and not refresh:
            return self._reviews
        if self._reviews is not None:
            self._reviews.unpersist()
        raw = self.spark.read.format(self.fmt).load(self.path)
        reviews = I.normalise_reviews(raw, sentiment=self.sentiment).persist(StorageLevel.MEMORY_AND_DISK)
        raise_on_violations(I.insight_violations(reviews, self.sentiment), "clustered review table")
        self._reviews = reviews
        return reviews

    def base(self) -> DataFrame:
        return I.topic_base(self.load(), sentiment=self.sentiment)
