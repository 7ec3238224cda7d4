"""S and Q9: reading, writing and exporting."""

from pyspark.sql import functions as F

from reviewloom.catalog import insights as IQ
from reviewloom.catalog.registry import ORACLE, query
from reviewloom.catalog.reports import GENERATED_AT, report_inputs
from reviewloom.catalog.topic_models import fitted_topics, reviews_of
from reviewloom.operators import insights as I
from reviewloom.operators import reports as P
from reviewloom.plans import fixtures as fx
from reviewloom.plans import model_store
from reviewloom.plans import workflows as W
from reviewloom.plans.fixtures import sql_over
from reviewloom.session import scratch_path
from reviewloom.sources import files
from reviewloom.sources.reviews import ReviewStore

CSV_COLUMNS = (
    "review_id",
    "product_name",
    "brand",
    "review_title",
    "review_text",
    "rating_raw",
    "review_date_raw",
    "do_recommend",
)
CSV_SCHEMA = "review_id bigint, " + ", ".join(f"{c} string" for c in CSV_COLUMNS[1:])
READ_BACK = ", ".join(c if c == "review_id" else f"nullif({c}, '') as {c}" for c in CSV_COLUMNS)


def blank_to_null(df):
    """Empty fields and missing fields are the same in a CSV file."""
    return df.withColumns({c: F.nullif(c, F.lit("")) for c in CSV_COLUMNS[1:]})


@query(
    "s01_csv_scan",
    sql_over("reviews_raw", body=f"select {READ_BACK}, 'merged_reviews' as source_dataset from reviews_raw"),
)
def csv_scan(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir).select(*CSV_COLUMNS)
    path = files.write_table(raw, scratch_path(spark, "merged_reviews"), "csv")
    return blank_to_null(files.read_csv(spark, path, CSV_SCHEMA, source="folder"))


@query(
    "s02_load_all",
    sql_over(
        "reviews_raw",
        body=f"""select {READ_BACK}, 'raw_' || coalesce(source_dataset, 'unnamed') as source_dataset
        from reviews_raw""",
    ),
)
def load_all(spark, sf_dir):
    """One CSV folder per source the table holds, read back and merged."""
    source = F.coalesce("source_dataset", F.lit("unnamed"))
    raw = fx.reviews_raw(spark, sf_dir).withColumn("source_dataset", source)
    root = scratch_path(spark, "raw")
    names = [r[0] for r in raw.select("source_dataset").distinct().orderBy("source_dataset").collect()]
    paths = {f"raw_{name}": f"{root}/{i}" for i, name in enumerate(names)}
    for name, path in zip(names, paths.values(), strict=True):
        part = raw.where(F.col("source_dataset") == name).select(*CSV_COLUMNS)
        files.write_table(part, path, "csv")
    tables = files.read_all(spark, paths, schema=CSV_SCHEMA)
    return blank_to_null(files.merge_datasets(tables.values()))


def three_shapes(raw):
    """Three sources with different columns."""
    rated = raw.where("source_dataset = 'en'").select("review_id", "review_text", "rating_raw", "do_recommend")
    titled = raw.where("source_dataset = 'de'").select("review_id", "review_title", "review_text")
    rest = raw.where("source_dataset not in ('en', 'de')").select("rating_raw", "review_id", "brand")
    return [rated, titled, rest]


@query(
    "s03_merge",
    sql_over(
        "reviews_raw",
        body="""select review_id, review_text, rating_raw, do_recommend from reviews_raw where source_dataset = 'en'
        union all by name select review_id, review_title, review_text from reviews_raw where source_dataset = 'de'
        union all by name select rating_raw, review_id, brand from reviews_raw
        where source_dataset not in ('en', 'de')""",
    ),
)
def merge(spark, sf_dir):
    return files.merge_datasets(three_shapes(fx.reviews_raw(spark, sf_dir)))


@query("s04_write_table", sql_over("reviews_labelled", body="select * from reviews_labelled"))
def write_table(spark, sf_dir):
    path = files.write_table(fx.reviews_labelled(spark, sf_dir), scratch_path(spark, "reviews"))
    return spark.read.parquet(path)


@query(
    "s05_write_json",
    sql_over("reviews_raw", body="select review_id, review_title, rating_raw from reviews_raw"),
)
def write_json(spark, sf_dir):
    """JSON documents written and parsed back, NULL fields included."""
    rows = fx.reviews_raw(spark, sf_dir).select("review_id", "review_title", "rating_raw")
    path = files.write_json(rows, scratch_path(spark, "rows.json"))
    return files.read_json(spark, path, "review_id bigint, review_title string, rating_raw string")


@query(
    "s06_write_report",
    rf"""select unnest(regexp_split_to_array(line, '\r\n|\r|\n')) as value
    from ({ORACLE['q08_report_lines']}) written""",
)
def write_report(spark, sf_dir):
    lines = P.report_lines(*report_inputs(spark, sf_dir), GENERATED_AT)
    return files.read_text(spark, files.write_report(lines, scratch_path(spark, "report.md")))


@query("s07_load_clustered", IQ.over_clustered(("dirty", IQ.DIRTY_SQL), body=IQ.NORMALISED_SQL))
def load_clustered(spark, sf_dir):
    path = files.write_table(IQ.dirty(spark, sf_dir), scratch_path(spark, "clustered"))
    store = ReviewStore(spark, path)
    store.load()
    return store.load(refresh=True)


@query(
    "s08_read_json",
    IQ.over_clustered(
        IQ.BASE, IQ.RATES, IQ.FACTS, body="select topic_id, topic_name, review_count, health, summary from facts"
    ),
)
def read_json(spark, sf_dir):
    facts = I.topic_facts(IQ.base(spark, sf_dir)).drop("all_reviews", "rating_sum", "rating_count")
    path = files.write_json(facts, scratch_path(spark, "topics.json"))
    schema = "topic_id int, topic_name string, review_count bigint, health string, summary string"
    return files.read_json(spark, path, schema)


@query("s09_model_roundtrip", sql_over("reviews_labelled", body="select review_id, true as same from reviews_labelled"))
def model_roundtrip(spark, sf_dir):
    """Per review: whether the saved and reloaded model assigns as the fitted one does."""
    model = model_store.load(fitted_topics(spark, sf_dir))
    path = scratch_path(spark, "topic_model")
    model.write().save(path)
    reviews = reviews_of(spark, sf_dir)
    before = model.transform(reviews).select("review_id", F.col("cluster_id").alias("before"))
    after = model_store.load(path).transform(reviews).select("review_id", F.col("cluster_id").alias("after"))
    return before.join(after, "review_id").select("review_id", F.equal_null("before", "after").alias("same"))


@query(
    "s10_artifact_status",
    f"select unnest({list(W.ARTIFACTS)}) as name, true as available, true as has_content",
)
def artifact_status(spark, sf_dir):
    root = scratch_path(spark, "artifacts")
    status = W.ensure_artifacts(fx.clustered(spark, sf_dir), root, GENERATED_AT)
    return status.select("name", "available", (F.col("size_bytes") > 0).alias("has_content"))


@query("q09_export_all")
def export_all(spark, sf_dir):
    """Every artifact written, read back as lines."""
    root = scratch_path(spark, "export")
    paths = W.export_all(fx.clustered(spark, sf_dir), root, GENERATED_AT)
    out = None
    for row in paths.collect():  # five artifacts
        part = files.read_text(spark, row["path"]).withColumn("artifact", F.lit(row["artifact"]))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "q09b_export_facts",
    sql_over(
        "clustered",
        body=f"""select artifact, topic_name, true as named from (select distinct topic_name from clustered) t
        cross join (select unnest({list(W.ARTIFACTS)}) as artifact) a""",
    ),
)
def export_facts(spark, sf_dir):
    """Per artifact and topic: is the topic named in it?"""
    reviews = fx.clustered(spark, sf_dir)
    paths = W.export_all(reviews, scratch_path(spark, "export"), GENERATED_AT)
    text = None
    for row in paths.collect():  # five artifacts
        part = files.read_text(spark, row["path"]).withColumn("artifact", F.lit(row["artifact"]))
        text = part if text is None else text.unionByName(part)
    whole = text.groupBy("artifact").agg(F.array_join(F.collect_list("value"), "\n").alias("text"))
    names = reviews.groupBy("topic_name").agg(F.lit(1).alias("one"))
    pairs = whole.withColumn("one", F.lit(1)).join(names, "one")
    return pairs.select("artifact", "topic_name", F.contains("text", "topic_name").alias("named"))
