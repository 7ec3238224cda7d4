"""Text features for the classical and the transformer branch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions import text as X
from reviewloom.plans.shapes import keep_first, require_columns
from reviewloom.session import materialise


def combine_review_text(
    df: DataFrame,
    title: str = "review_title",
    text: str = "review_text",
    output: str = "normalized_combined_text",
    separator: str = " ",
) -> DataFrame:
    require_columns(df, [title, text], "review table")
    both = F.concat_ws(separator, F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))
    return df.withColumn(output, X.normalise_text(both))


def drop_normalised_duplicates(
    df: DataFrame,
    text: str = "normalized_combined_text",
    rating: str = "rating",
    include_rating: bool = True,
) -> DataFrame:
    """First review (smallest review_id) per normalised text, or text and rating."""
    keys = [text, rating] if include_rating else [text]
    require_columns(df, keys, "review table")
    return keep_first(df, keys, dear=True)


def add_classical_text(
    df: DataFrame,
    source: str = "normalized_combined_text",
    output: str = "classical_text",
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    return df.withColumn(output, X.classical_text(F.col(source), stop_words))


HEAVY_TOKENS = 1000  # tokens that may each hold more than a thousandth of all tokens


def lemmatise_with_dictionary(
    df: DataFrame, dictionary: DataFrame, column: str = "classical_text", key: str = "review_id"
) -> DataFrame:
    """Replace tokens through a (token, lemma) table of any size; unknown tokens stay.

    A sketch of frequent items names the heavy tokens.  Their lemmas, at most that many
    rows, are broadcast to the places where they stand; the other tokens, none of which
    holds more than a small share of all, meet the dictionary by a shuffle.  Of several
    lemmas of a token the first in order counts.
    """
    require_columns(dictionary, ["token", "lemma"], "lemma dictionary")
    words = df.select(key, F.posexplode(F.split(column, " ")).alias("pos", "token"))
    lemmas = dictionary.groupBy("token").agg(F.min("lemma").alias("lemma"))
    # Ten counters per reported token keep the sketch's error far below a heavy share.
    frequent = words.agg(F.expr(f"approx_top_k(token, {HEAVY_TOKENS}, {10 * HEAVY_TOKENS})").alias("top"))
    heavy = materialise(frequent.select(F.explode("top.item").alias("token")).where("token is not null"))
    known = heavy.join(lemmas, "token", "left").select("token", F.col("lemma").alias("__heavy"), F.lit(True).alias("__is"))
    marked = words.join(F.broadcast(known), "token", "left")
    light = marked.where("__is is null").join(lemmas, "token", "left")
    looked_up = marked.where("__is").select(
        key, "pos", F.coalesce("__heavy", "token").alias("lemma")
    ).unionByName(light.select(key, "pos", F.coalesce("lemma", "token").alias("lemma")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "lemma")))
    joined = looked_up.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda x: x.lemma), " ").alias(column)
    )
    return df.drop(column).join(joined, key)


def model_text_features(
    df: DataFrame,
    remove_duplicates: bool = True,
    include_rating: bool = True,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Both text branches from title and body."""
    combined = combine_review_text(df).where(F.length("normalized_combined_text") > 0)
    if remove_duplicates:
        combined = drop_normalised_duplicates(combined, include_rating=include_rating)
    return combined.withColumn(
        "transformer_text", F.col("normalized_combined_text")
    ).transform(add_classical_text, stop_words=stop_words)


def feature_violations(df: DataFrame) -> DataFrame:
    """Row count per broken rule of the feature table."""
    require_columns(
        df, ("normalized_combined_text", "transformer_text", "classical_text"), "feature table"
    )
    rules = {
        "branches_differ": ~F.col("transformer_text").eqNullSafe(F.col("normalized_combined_text")),
        "empty_normalized": F.coalesce(F.length("normalized_combined_text"), F.lit(0)) == 0,
        "empty_transformer": F.coalesce(F.length("transformer_text"), F.lit(0)) == 0,
        "missing_classical": F.col("classical_text").isNull(),
    }
    return df.agg(*[F.count_if(test).alias(name) for name, test in rules.items()]).unpivot(
        [], list(rules), "rule", "violations"
    )


def drop_low_content(
    df: DataFrame,
    column: str = "classical_text",
    min_tokens: int = S.MIN_CONTENT_TOKENS,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Reviews with at least ``min_tokens`` tokens that are not stop words."""
    require_columns(df, [column], "feature table")
    stops = X.topic_stop_words() if stop_words is None else stop_words
    words = X.drop_words(X.split_words(F.lower(column)), stops)
    return df.where(F.size(words) >= min_tokens)


def stop_word_table(spark, extra: Iterable[str] = ()) -> DataFrame:
    """The topic stop words as a one-column table."""
    return spark.createDataFrame([(w,) for w in X.topic_stop_words(extra)], "word string")


def model_input(
    df: DataFrame,
    text: str = "classical_text",
    label: str = "sentiment_label",
    labels: Iterable[str] = S.SENTIMENT_LABELS,
) -> DataFrame:
    """Rows with a known label and non-blank text, text trimmed."""
    require_columns(df, [text, label], "model table")
    return (
        df.where(F.col(label).isin(*labels))
        .withColumn(text, X.strip(F.col(text)))
        .where(F.length(text) > 0)
    )
