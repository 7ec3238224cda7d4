"""L1-L7: topic labelling queries over term lists derived from the clustered reviews."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.catalog import sqltext as T
from reviewloom.catalog.registry import query
from reviewloom.functions import text as X
from reviewloom.operators import labeling as L
from reviewloom.operators import topics as P
from reviewloom.plans import fixtures as fx
from reviewloom.plans.fixtures import sql_over

# Two term lists per topic: its name's words and most frequent words, and the
# same after five filler words (so that some lists are generic and names repeat).
FILLER = ("great", "good", "love", "easy", "price")
NAME_WORDS = "regexp_extract_all(lower(topic_name), '[a-z]{2,}')"
LISTS = (
    (
        "frequent",
        f"""select cluster_id, list(token order by n desc, token) as top from (select *, row_number() over (
      partition by cluster_id order by n desc, token) as k from (select cluster_id, token, count(*) as n
      from (select cluster_id, unnest({T.tokens(T.classical_clean('review_text'))}) as token from clustered) a
      group by 1, 2) b) c where k <= 6 group by 1""",
    ),
    (
        "named",
        f"""select distinct cluster_id, list_concat({NAME_WORDS}, top) as terms
      from (select distinct cluster_id, topic_name from clustered) t join frequent using (cluster_id)""",
    ),
    (
        "lists",
        f"""select cluster_id, terms from named union all
      select cluster_id + 6, list_concat({T.word_list(FILLER)}, terms) from named""",
    ),
    (
        "tokens8",
        """select cluster_id, rank - 1 as rank, unnest(regexp_split_to_array(lower(term), '\\s+')) as token from (
      select cluster_id, unnest(terms[:8]) as term, unnest(range(1, len(terms[:8]) + 1)) as rank from lists) q""",
    ),
    (
        "taxonomy",
        "select * from (values "
        + ", ".join(
            f"({i}, {T.quoted(name)}, '{word}')"
            for i, (name, words) in enumerate(S.TOPIC_TAXONOMY)
            for word in words
        )
        + ") as t(priority, category, token)",
    ),
    (
        "matched",
        """select cluster_id, category, hits, first_rank from (select *, row_number() over (
      partition by cluster_id order by hits desc, first_rank, priority) as n from (
      select cluster_id, category, priority, count(distinct rank) as hits, cast(min(rank) as int) as first_rank
      from tokens8 join taxonomy using (token) group by 1, 2, 3) a) b where n = 1""",
    ),
    (
        "generic",
        f"""select cluster_id, coalesce(avg(case when list_contains({T.word_list(S.GENERIC_TERMS)}, token)
      then 1.0 else 0.0 end) >= 0.6, true) as generic from lists left join tokens8 using (cluster_id) group by 1""",
    ),
)


def over_lists(n, body):
    return sql_over("clustered", *LISTS[:n], body=body)


def lists(spark, sf_dir):
    reviews = fx.clustered(spark, sf_dir, spread=True)
    words = reviews.select(
        "cluster_id", F.explode(X.tokens(X.classical_clean(F.col("review_text")))).alias("token")
    )
    order = Window.partitionBy("cluster_id").orderBy(F.desc("n"), F.asc("token"))
    frequent = (
        words.groupBy("cluster_id", "token")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(order))
        .where("rank <= 6")
    )
    names = reviews.select("cluster_id", "topic_name").distinct()
    name_words = F.regexp_extract_all(F.lower("topic_name"), F.lit("[a-z]{2,}"), F.lit(0))
    named = names.join(L.terms_list(frequent.withColumnRenamed("token", "term")), "cluster_id").select(
        "cluster_id", F.concat(name_words, "terms").alias("terms")
    )
    filler = F.array(*[F.lit(w) for w in FILLER])
    return named.unionByName(
        named.select((F.col("cluster_id") + 6).alias("cluster_id"), F.concat(filler, "terms").alias("terms"))
    )


@query("l01_match_category", over_lists(6, "select * from matched"))
def match(spark, sf_dir):
    return L.match_category(lists(spark, sf_dir))


@query("l02_is_generic", over_lists(7, "select * from generic"))
def generic(spark, sf_dir):
    return L.is_generic(lists(spark, sf_dir))


@query(
    "l03_topic_names",
    over_lists(
        7,
        f"""select cluster_id, case when category is null or (hits = 1 and generic)
        then '{S.UNCATEGORISED}' else category end as topic_name
        from lists left join matched using (cluster_id) join generic using (cluster_id)""",
    ),
)
def names(spark, sf_dir):
    return L.raw_topic_names(lists(spark, sf_dir)).select("cluster_id", "topic_name")


RAW_NAMES = (
    "raw_names",
    f"""select cluster_id, terms[:{S.NAMING_TERMS}] as terms, case when category is null or (hits = 1 and generic)
      then '{S.UNCATEGORISED}' else category end as topic_name
      from lists left join matched using (cluster_id) join generic using (cluster_id)""",
)
PLACED = (
    "placed",
    """select *, row_number() over (partition by topic_name order by cluster_id) as pos,
      count(*) over (partition by topic_name) as clusters from raw_names""",
)
TERM_TOKENS = r"list_filter(regexp_split_to_array(lower(t), '\s+'), lambda w: w <> '')"
FILLER_ONLY = f"""coalesce(len(list_filter({TERM_TOKENS}, lambda w: list_contains({T.word_list(S.GENERIC_TERMS)}, w)))
  / nullif(len({TERM_TOKENS}), 0) >= {S.GENERIC_SHARE}, true)"""


def marker_sql(used: str) -> str:
    free = f"list_filter(p.terms, lambda t: not list_contains({used}, t))"
    return f"coalesce(list_filter({free}, lambda t: not {FILLER_ONLY})[1], {free}[1], 'cluster ' || p.cluster_id)"


# The fold as a recursion over the clusters of a name.
FOLDED = (
    "folded",
    f"""select p.cluster_id, p.topic_name, p.pos, p.clusters, {marker_sql("[]::varchar[]")} as marker,
      [{marker_sql("[]::varchar[]")}] as used from placed p where pos = 1
    union all
    select p.cluster_id, p.topic_name, p.pos, p.clusters, {marker_sql("f.used")},
      list_append(f.used, {marker_sql("f.used")}) from folded f
      join placed p on p.topic_name = f.topic_name and p.pos = f.pos + 1""",
)


@query(
    "l04_disambiguate",
    sql_over(
        "clustered",
        *LISTS,
        RAW_NAMES,
        PLACED,
        FOLDED,
        body="""select cluster_id, case when clusters > 1 then topic_name || ' (' || marker || ')'
        else topic_name end as topic_name from folded""",
    ).replace("with ", "with recursive ", 1),
)
def disambiguated(spark, sf_dir):
    return L.suggest_topic_names(lists(spark, sf_dir))


@query("l05_terms_list", over_lists(3, "select cluster_id, array_to_string(terms, ', ') as terms from lists"))
def terms(spark, sf_dir):
    return L.terms_list(
        lists(spark, sf_dir).select("cluster_id", F.posexplode("terms").alias("rank", "term"))
    ).select("cluster_id", F.array_join("terms", ", ").alias("terms"))


@query(
    "l06_quality_report",
    sql_over(
        "clustered",
        *LISTS,
        (
            "samples",
            """select cluster_id, string_agg(review_text, ' | ' order by rank) as sample_reviews from (
          select cluster_id, review_text, row_number() over (partition by cluster_id
            order by length(review_text), review_id) as rank from clustered) q where rank <= 3 group by 1""",
        ),
        body="""select cluster_id, topic_name as name, size, array_to_string(terms[:8], ', ') as top_terms,
        sample_reviews, not generic as coherent, round(size / sum(size) over () * 100, 2) as pct
        from named join generic using (cluster_id) join samples using (cluster_id)
        join (select cluster_id, topic_name, count(*) as size from clustered group by 1, 2) s using (cluster_id)""",
    ),
)
def quality(spark, sf_dir):
    reviews = fx.clustered(spark, sf_dir)
    shortest = reviews.select("review_id", "cluster_id", "review_text", F.length("review_text").alias("size"))
    nearest = P.nearest_to_centroid(shortest, n=5, distance="size")
    return L.quality_report(
        lists(spark, sf_dir).where("cluster_id < 6"),
        nearest,
        sizes=P.cluster_sizes(reviews),
        names=reviews.select("cluster_id", "topic_name").distinct(),
    )


@query(
    "l07_size_resolver",
    sql_over(
        "clustered",
        body="""select shape, cluster_id, size from (select cluster_id, count(*) as size from clustered group by 1) q
        cross join (values ('count column'), ('other names'), ('last column')) as s(shape)""",
    ),
)
def size_resolver(spark, sf_dir):
    counted = P.cluster_sizes(fx.clustered(spark, sf_dir))
    shapes = {
        "count column": counted,
        "other names": counted.select(F.col("cluster_id").alias("id"), "percentage", F.col("review_count").alias("n")),
        "last column": counted.select("cluster_id", "percentage", F.col("review_count").alias("how_many")),
    }
    out = None
    for name, table in shapes.items():
        part = L.size_table(table).withColumn("shape", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
