"""URL filtering by association rules.

URLs become sets of tokens (scheme, host and parent domains, parts of hyphened
labels, path parts, query names).  The tokens of labelled pages are baskets, with one
more token that says whether the page is bad; rules "tokens => bad" are kept that reach a
support and a confidence and are not implied by a smaller rule of no less confidence,
however many tokens they have.

Sets of tokens are grown level by level, and counted on the whole baskets at each level
(Apriori).  Only sets that can be part of a rule are grown: those on enough bad pages, on
fewer pages than each of their parts (else a part has the same pages and implies them, as
a host does its parent domains), and with a page that is not bad (else they imply whatever
holds them).  So no rule is left out, and what is listed does not double with every token.
Tokens that stand on the very same labelled pages are mined as one, and a URL fits by any
of them.

An inverted index on each rule's token that is rarest among the URLs finds the rules
that may fit a URL; a rule fits when the URL holds all its tokens.

Given (host, path) rules go first.  A rule fits its host and all subdomains if the
URL's path starts with the rule's path; the longest rule wins.

A null URL, or one without "://", has an empty host and path and no tokens: no rule
fits and it is allowed.  Labels that are null or of unknown pages are left out; without
LEAST_PAGES bad pages nothing is mined.  Each distinct URL is judged once; repeated rows
and null ids keep their rows.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, staged

# (rule, verdict): the host up to the first slash, the path from there on.
GIVEN = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
LEAST_SUPPORT = 0.002  # of the labelled pages
LEAST_PAGES = 20  # and so many labelled pages at least
LEAST_CONFIDENCE = 0.8
PARENTS = 8  # labels of the longest parent domain that is a token; the whole host is one too
SALTS = 16  # parts of the URLs that share an index token

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(urls: DataFrame) -> DataFrame:
    """``host`` and ``path`` beside a column ``url``."""
    at = urls.withColumn("__at", F.coalesce(F.instr("url", "://"), F.lit(0)))
    rest = F.when(F.col("__at") > 0, F.expr("substring(url, __at + 3)")).otherwise("")
    cut = at.withColumn("__rest", rest)
    host = F.regexp_extract("__rest", r"^[^/?#]*", 0)
    path = F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    return cut.select(
        *urls.columns,
        F.translate(host, UPPER, UPPER.lower()).alias("host"),
        path.alias("path"),
    )


def host_suffixes(host: Column, most: int = PARENTS) -> Column:
    """The host and its parent domains of at most so many labels: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most))),
        lambda i: F.concat_ws(".", F.slice(labels, n - i + 1, i)),
    )
    return F.array_distinct(F.concat(F.array(host), parents))


def given_rules(urls: DataFrame, rules) -> DataFrame:
    """(url, rule, verdict): the longest given rule that fits each distinct URL."""
    table = urls.sparkSession.createDataFrame(
        [(r, r.split("/", 1)[0], "/" + r.split("/", 1)[1], v) for r, v in rules],
        "rule string, rule_host string, rule_path string, given string",
    )
    # A longer suffix than the longest host of a rule equals none of them.
    longest_host = max((r.split("/", 1)[0].count(".") + 1 for r, _ in rules), default=1)
    candidates = urls.select(
        "url", "path", F.explode(host_suffixes(F.col("host"), longest_host)).alias("rule_host")
    )
    # The given rules are a short constant of the program.
    fits = candidates.join(F.broadcast(table), "rule_host").where(
        F.expr("startswith(path, rule_path)")
    )
    longest = F.max_by(F.struct("rule", "given"), F.struct(F.length("rule"), "rule"))
    return fits.groupBy("url").agg(longest.alias("best")).select("url", "best.rule", "best.given")


def tokens(urls: DataFrame) -> DataFrame:
    """``tokens`` beside url, host and path; digits in path parts become 0."""
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    plain = F.transform(parts, lambda p: F.regexp_replace(p, r"[0-9]+", "0"))
    query = F.regexp_extract("url", r"(?s)\?([^#]*)", 1)
    names = F.filter(
        F.transform(F.split(query, "&"), lambda q: F.element_at(F.split(q, "="), 1)),
        lambda q: q != "",
    )
    kinds = [
        F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index("url", "://", 1)))),
        F.transform(host_suffixes(F.col("host")), lambda h: F.concat(F.lit("host="), h)),
        F.transform(
            F.when(F.col("host").contains("-"), F.split("host", r"\.|-")).otherwise(F.array()),
            lambda h: F.concat(F.lit("label_part="), h),
        ),
        F.transform(plain, lambda p: F.concat(F.lit("path="), p)),
        F.transform(names, lambda q: F.concat(F.lit("query="), q)),
        F.when(F.col("url").contains("#"), F.array(F.lit("fragment"))).otherwise(F.array()),
    ]
    found = F.array_distinct(F.concat(*kinds))
    none = F.array().cast("array<string>")
    return urls.withColumn("tokens", F.when(F.col("host") != "", found).otherwise(none))


def mined_rules(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, confidence): pruned rules "tokens => bad" of the labelled pages.

    ``pages`` has (page_id, url, tokens); a page is bad by quality 0 or toxic 1.  Of tokens
    on the very same labelled pages a rule names the first.
    """
    return _mined(pages, labels)[0]


def _mined(pages: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rules, and (token, name): the name by which rules know a token."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False))) | F.coalesce(
        F.col("toxic") == 1, F.lit(False)
    )
    judged = (
        labels.where("doc_id is not null and (quality is not null or toxic is not null)")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.max(bad.cast("int")).alias("bad"))
    )
    baskets = staged(
        pages.where(F.size("tokens") > 0)
        .join(judged, "page_id")
        .select(
            F.monotonically_increasing_id().alias("page_id"),
            F.col("tokens").alias("items"),
            "bad",
        ),
        "baskets",
    )
    n, n_bad = baskets.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")
    ).first()
    spark = pages.sparkSession
    no_rules = spark.createDataFrame([], "tokens array<string>, confidence double")
    no_names = spark.createDataFrame([], "token string, name string")
    if not n_bad:
        return no_rules, no_names
    # A rule needs LEAST_PAGES bad pages, so rarer items cannot be part of one.
    support = max(LEAST_SUPPORT, LEAST_PAGES / n)
    least = math.ceil(support * n - 1e-9)
    if least > n_bad:
        return no_rules, no_names
    classes = staged(_token_classes(baskets, least), "classes")
    names = classes.select(F.explode("members").alias("token"), "name")
    rules = staged(
        _frequent_sets(baskets, classes, least)
        .where(F.col("bad") >= LEAST_CONFIDENCE * F.col("pages"))
        .select("tokens", (F.col("bad") / F.col("pages")).alias("confidence")),
        "rules",
    )
    # A rule is implied by one of fewer of its tokens that is as sure.
    smaller = rules.select(
        F.element_at("tokens", 1).alias("token"),
        F.col("tokens").alias("fewer"),
        F.col("confidence").alias("sure"),
    )
    implied = (
        rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
        .join(smaller, "token")
        .where(
            (F.size("fewer") < F.size("tokens"))
            & (F.size(F.array_except("fewer", "tokens")) == 0)
            & (F.col("sure") >= F.col("confidence"))
        )
        .select("tokens")
        .distinct()
    )
    return rules.join(implied, "tokens", "left_anti"), names


def _token_classes(baskets: DataFrame, least: int) -> DataFrame:
    """(name, members, pages, bad): tokens on at least ``least`` bad pages; those that stand
    on the same pages together, under the first of them."""
    each = baskets.select("page_id", "bad", F.explode("items").alias("token"))
    # Equal sets of pages by their size and two hashes of 64 bits.
    marks = each.groupBy("token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("bad").alias("bad"),
        *[F.bit_xor(F.xxhash64("page_id", F.lit(i))).alias(f"h{i}") for i in (1, 2)],
    )
    return (
        marks.where(F.col("bad") >= least)
        .groupBy("pages", "bad", "h1", "h2")
        # Tokens on the same pages: no more than one basket holds.
        .agg(F.min("token").alias("name"), F.collect_list("token").alias("members"))
        .select("name", "members", "pages", "bad")
    )


def _frequent_sets(baskets: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """(tokens, pages, bad): every set of names on ``least`` bad pages that no part of it
    implies, with its counts over all baskets.

    A level extends the sets of the one before that some page holds which is not bad.
    """
    level = classes.select(F.array("name").alias("tokens"), "pages", "bad")
    found = level
    wanted = level.where("bad < pages")
    held = staged(
        baskets.select("page_id", "bad", F.explode("items").alias("name"))
        .join(classes.where("bad < pages").select("name"), "name")
        .select("page_id", "bad", F.array("name").alias("tokens")),
        "held",
    )
    while not held.isEmpty():
        # Two sets of a page that differ in their last token make one of the next level.
        start = F.slice("tokens", F.lit(1), F.size("tokens") - 1)
        ends = held.groupBy("page_id", "bad", start.alias("start")).agg(
            F.collect_list(F.element_at("tokens", -1)).alias("ends")
        )
        pairs = (
            ends.where(F.size("ends") > 1)
            .select("page_id", "bad", "start", "ends", F.explode("ends").alias("a"))
            .select("page_id", "bad", "start", "a", F.explode("ends").alias("b"))
            .where("a < b")
            .select("page_id", "bad", F.concat("start", F.array("a", "b")).alias("tokens"))
        )
        counted = staged(
            pairs.groupBy("tokens")
            .agg(F.count(F.lit(1)).alias("pages"), F.sum("bad").alias("bad"))
            .where(F.col("bad") >= least),
            "counted",
        )
        # All parts of one token less must be there, each on more pages.
        parts = counted.select(
            F.col("tokens").alias("whole"),
            F.col("pages").alias("own"),
            F.explode(
                F.transform("tokens", lambda t: F.filter("tokens", lambda u: u != t))
            ).alias("tokens"),
        )
        sound = (
            parts.join(wanted.select("tokens", "pages"), "tokens")
            .where("pages > own")
            .groupBy(F.col("whole").alias("tokens"))
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n = size(tokens)")
            .select("tokens")
        )
        level = staged(counted.join(sound, "tokens"), "level")
        found = found.unionByName(level)
        wanted = level.where("bad < pages")
        held = staged(pairs.join(wanted.select("tokens"), "tokens", "left_semi"), "held")
    return found


def _holding(rows: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """The rows (key, tokens, ...) with each of the rules (tokens, ...) whose tokens they hold.

    Rules are looked up by their token that fewest rows hold; the rows that share one are
    spread over SALTS tasks.
    """
    listed = rules.withColumnRenamed("tokens", "rule_tokens")
    each = listed.select("rule_tokens", F.explode("rule_tokens").alias("token"))
    wanted = each.select("token").distinct()
    share = (
        rows.select(F.explode("tokens").alias("token"))
        .join(wanted, "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    index = (
        each.join(share, "token", "left")
        .groupBy("rule_tokens")
        .agg(F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "token")).alias("rarest"))
        .select("rule_tokens", F.col("rarest.token").alias("token"))
        .join(listed, "rule_tokens")
        .withColumn("salt", F.explode(F.sequence(*(F.lit(n).cast("bigint") for n in (0, SALTS - 1)))))
    )
    spread = rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    return (
        spread.withColumn("token", F.explode("tokens"))
        # Equal arrays shrink so well in a shuffle that a long index would look broadcastable.
        .join(index.hint("merge"), ["token", "salt"])
        .where(F.size(F.array_except("rule_tokens", "tokens")) == 0)
        .drop("token", "salt")
    )


def matched(urls: DataFrame, rules: DataFrame, names: DataFrame) -> DataFrame:
    """(url, confidence): URLs that hold all tokens of a rule, by any token of each name."""
    named = (
        urls.select("url", F.explode("tokens").alias("token"))
        .join(names, "token")
        .groupBy("url")
        .agg(F.collect_set("name").alias("tokens"))
    )
    fits = _holding(named, rules, "url")
    return fits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(
    pages: DataFrame, labels: DataFrame, rules=GIVEN, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict, confidence) for every page."""
    own = staged(
        pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url")),
        "pages",
    )
    distinct = parsed(own.select("url").where("url is not null").distinct())
    distinct = staged(tokens(distinct), "urls")
    baskets = own.join(distinct.select("url", "tokens"), "url")
    rules_mined, names = _mined(baskets.select("page_id", "url", "tokens"), labels)
    verdicts = (
        distinct.select("url", "host", "path")
        .join(given_rules(distinct, rules), "url", "left")
        .join(matched(distinct, rules_mined, names), "url", "left")
        .select(
            "url",
            "host",
            "path",
            "rule",
            F.coalesce(
                "given", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
            ).alias("verdict"),
            "confidence",
        )
    )
    return own.join(verdicts, "url", "left").select(
        F.col("page_id").alias(id_col),
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        "confidence",
    )


def op9_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
