"""A fitted topic model kept as files, and queries on it."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from reviewloom.catalog.registry import query
from reviewloom.operators import stages
from reviewloom.operators import topics as P
from reviewloom.plans import fixtures as fx
from reviewloom.plans import model_store
from reviewloom.plans.fixtures import sql_over


def reviews_of(spark, sf_dir, spread=False):
    return fx.reviews_labelled(spark, sf_dir, spread).select("review_id", "review_text")


def fitted_topics(spark, sf_dir) -> str:
    """Folder of the fitted pipeline; the training assignment is beside it."""

    def fit(path: str) -> PipelineModel:
        text = stages.ClassicalText()
        model, assigned = P.fit_topic_model(text.transform(reviews_of(spark, sf_dir, spread=True)))
        assigned.select("review_id", "cluster_id").write.mode("overwrite").parquet(f"{path}-assigned")
        P.release(assigned)
        return PipelineModel([text, stages.TopicFinderModel(model)])

    return model_store.stored(spark, "topics", sf_dir, fit)


@query("v14_predict_topics")
def predict(spark, sf_dir):
    """Training assignment next to the prediction of the saved model for the same texts.

    Texts without a word take no part in a fit: they have no training assignment, and
    ``same`` is NULL.
    """
    path = fitted_topics(spark, sf_dir)
    fitted = spark.read.parquet(f"{path}-assigned").withColumnRenamed("cluster_id", "fitted_cluster")
    predicted = model_store.load(path).transform(reviews_of(spark, sf_dir)).select(
        "review_id", F.col("cluster_id").alias("predicted_cluster")
    )
    both = predicted.join(fitted, "review_id", "left")
    return both.withColumn("same", F.col("fitted_cluster") == F.col("predicted_cluster"))


@query(
    "v14b_prediction_facts",
    sql_over("reviews_labelled", body="select review_id, true as in_range, true as same from reviews_labelled"),
)
def prediction_facts(spark, sf_dir):
    """Per review: a cluster of the model, and the one of the fit where there was one."""
    known = F.col("predicted_cluster").between(0, P.S.N_CLUSTERS - 1)
    return predict(spark, sf_dir).select(
        "review_id", known.alias("in_range"), F.coalesce("same", F.lit(True)).alias("same")
    )
