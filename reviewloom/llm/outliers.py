"""Quality rules by robust multivariate outliers.

Every text gets a few statistics (words, symbols, repeated lines, repeated 3-word
windows), all of them DataFrame expressions over the whole text.  Two fixed rules
fail a text outright.  For the others the statistics become a vector of DIMENSIONS
transformed numbers, and per language and source a minimum-covariance-determinant
estimate is made: from two starts, concentration steps keep the SUBSET of the rows
that lie nearest and estimate mean and covariance again; after FIRST_STEPS the start
with the smaller determinant goes on until its determinant settles.  Covariances are
scaled so that the median distance fits a normal sample.  A text is rejected when its
squared Mahalanobis distance is over CUTOFF.

The same is done per language and for all rows.  Each estimate is drawn toward the
next coarser one by its number of rows, n / (n + STRENGTH), and the one of all rows
toward a wide prior, so a rare source is judged mostly by its language and no size of
group is treated in another way.  The nearest rows are found by percentile_approx
(rank error 1 in 10,000), so a group of any size is reduced by partial aggregates.

Null and empty texts have no words and fail the word count.  Null language or
source are values of their own.  Null ids and repeated rows keep their rows; ties in
distance are kept together.  Empty table: no rows.  Columns of other names are not
read.  The windows of one text are compared by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import read_table, staged

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
SUBSET = 0.75
FIRST_STEPS = 2
SETTLED = 0.01  # fall of the log determinant that asks for no further step
STRENGTH = 20.0  # rows that the next coarser estimate is worth
SALTS = 64  # parts of a frequent language and source in joins
DIMENSIONS = 5
# Spread that counts as none, by dimension: keeps a constant statistic from
# rejecting every text that differs a little.  Shares of lines and words are of small
# numbers and vary more than shares of characters.
FLOORS = (0.05, 0.03, 0.03, 0.10, 0.10)
PRIOR = 0.3  # spread of every dimension where nothing is known
MEDIAN = 4.351  # of chi-square with 5 degrees of freedom
# Squared distance that a normal vector passes once in 10^11: text statistics have
# heavier tails than a normal sample, and clean texts are to stay.
CUTOFF = 60.0

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bars")
AXES = range(1, DIMENSIONS + 1)


def _repeat_words(sorted_windows: Column) -> Column:
    """Words in windows found twice; input: (hash, place) structs in order."""
    s = sorted_windows
    twice = F.filter(
        s,
        lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        places,
        start,
        lambda acc, at: F.struct(
            at.alias("last"), (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with a struct column ``__s`` of STATS."""
    keep = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    first = docs.select(
        *keep,
        words.alias("__words"),
        lines.alias("__lines"),
        F.length(F.translate(text, SPACES, "")).alias("__chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("__symbols"),
        (F.length(text) - F.length(F.translate(text, "|", ""))).alias("__bars"),
    )
    w = F.col("__words")
    windows = F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    )
    rest = ["__lines", "__chars", "__symbols", "__bars"]
    second = first.select(*keep, *rest, F.size(w).alias("__n"), windows.alias("__h"))
    h = F.col("__h")
    # Only texts with a window found twice need their windows in order.
    ordered = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    )
    third = second.select(*keep, *rest, "__n", ordered.alias("__w"))
    lines = F.col("__lines")
    values = {
        "n_words": F.col("__n"),
        "word_chars": F.col("__chars"),
        "n_symbols": F.col("__symbols"),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(_repeat_words(F.col("__w")), F.lit(0)),
        "n_lines": F.size(lines),
        "n_bars": F.col("__bars"),
    }
    return third.select(
        *keep, F.struct(*[values[n].cast("bigint").alias(n) for n in STATS]).alias("__s")
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < LEAST_WORDS) | (
        100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"]
    )


def vector(s: Column) -> list[Column]:
    """The transformed statistics: word length, and shares of bars, other symbols, repeats."""

    def share(part: str, whole: str, less: Column = F.lit(0)) -> Column:
        return F.sqrt((s[part] - less) / F.greatest(s[whole], F.lit(1)))

    return [
        F.log((s["word_chars"] + 1) / (s["n_words"] + 1)),
        share("n_symbols", "word_chars", s["n_bars"]),
        share("n_bars", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]


def _site(name: str) -> Column:
    """A non-null key for a value that may be null."""
    value = F.col(f"`{name}`").cast("string")
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value))


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance (with the floors added) of the vectors of each key."""
    pairs = [(i, j) for i in AXES for j in AXES if i >= j]
    sums = rows.groupBy(*keys).agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in AXES],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in pairs],
    )
    floors = {f"c{i}{i}": F.col(f"c{i}{i}") + FLOORS[i - 1] ** 2 for i in AXES}
    return sums.withColumns(floors)


def _factored(moments: DataFrame) -> DataFrame:
    """Cholesky factors l_ij of the covariance, and the log of its determinant."""
    out = moments
    for j in AXES:
        inner = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(1, j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.col(f"c{j}{j}") - inner))
        for i in range(j + 1, DIMENSIONS + 1):
            cross = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(1, j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - cross) / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in AXES), F.lit(0.0))
    factors = [f"l{i}{j}" for i in AXES for j in AXES if i >= j]
    return out.select(*moments.columns, *factors, det.alias("det"))


def _with_distance(rows: DataFrame) -> DataFrame:
    """``d``: squared Mahalanobis distance, from x, m and l columns on the row."""
    out = rows
    for i in AXES:
        known = sum((F.col(f"l{i}{k}") * F.col(f"__z{k}") for k in range(1, i)), F.lit(0.0))
        out = out.withColumn(
            f"__z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - known) / F.col(f"l{i}{i}")
        )
    d = sum((F.col(f"__z{i}") * F.col(f"__z{i}") for i in AXES), F.lit(0.0))
    return out.withColumn("d", d).drop(*[f"__z{i}" for i in AXES])


def _salted(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """rows (with ``salt``) joined to a table with one row per key, repeated for every salt."""
    spread = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(spread, [*keys, "salt"])


def _salt() -> Column:
    """Deals the rows of a stored table evenly, equal ones too."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")


def _concentrated(grouped: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Estimates of the SUBSET of the rows that lie nearest by the given estimates.

    keys: level, g1, g2, and the start where the estimates have two.
    """
    xs = [f"x{i}" for i in AXES]
    far = _with_distance(_salted(grouped, state, keys[:3])).select(*keys, "salt", *xs, "d")
    far = staged(far, "distances")
    cut = far.groupBy(*keys).agg(F.percentile_approx("d", SUBSET, 10_000).alias("cut"))
    near = _salted(far, cut, keys).where("d <= cut")
    return staged(_factored(_moments(near, keys)), "state")


def _drawn(own: dict[str, Column], coarse: dict[str, Column], n: Column) -> dict[str, Column]:
    """Means and covariances of a mixture of n own rows and STRENGTH of the coarser estimate."""
    w = n / (n + STRENGTH)
    out = {f"m{i}": w * own[f"m{i}"] + (1 - w) * coarse[f"m{i}"] for i in AXES}
    apart = {i: own[f"m{i}"] - coarse[f"m{i}"] for i in AXES}
    for i in AXES:
        for j in range(1, i + 1):
            c = f"c{i}{j}"
            out[c] = w * own[c] + (1 - w) * coarse[c] + w * (1 - w) * apart[i] * apart[j]
    return out


def fit(rows: DataFrame) -> DataFrame:
    """Estimates m and l by (lang, source); input columns lang, source (keys), __s."""
    s = F.col("__s")
    xs = [f"x{i}" for i in AXES]
    pairs = [(i, j) for i in AXES for j in AXES if i >= j]
    points = staged(
        rows.where(~base_failed(s)).select(
            "lang", "source", *[x.alias(n) for n, x in zip(xs, vector(s), strict=True)], _salt()
        ),
        "points",
    )
    none = F.lit("")
    levels = [(none, none), (F.col("lang"), none), (F.col("lang"), F.col("source"))]
    level = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("level"), a.alias("g1"), b.alias("g2"))
                for k, (a, b) in enumerate(levels)
            ]
        )
    )
    grouped = points.select("salt", *xs, level.alias("k")).select("k.*", "salt", *xs)
    key = ["level", "g1", "g2"]
    # Start 0: medians and quartile ranges.  Start 1: plain mean and covariance.
    quartiles = grouped.groupBy(*key).agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75]).alias(x) for x in xs]
    )
    robust = quartiles.select(
        *key,
        F.lit(0).alias("start"),
        *[F.col(f"x{i}")[1].alias(f"m{i}") for i in AXES],
        *[
            (
                F.pow((F.col(f"x{i}")[2] - F.col(f"x{i}")[0]) / 1.349, 2) + FLOORS[i - 1] ** 2
                if i == j
                else F.lit(0.0)
            ).alias(f"c{i}{j}")
            for i, j in pairs
        ],
    )
    plain = _moments(grouped, key).withColumn("start", F.lit(1))
    state = staged(_factored(robust.unionByName(plain)), "state")
    for _ in range(FIRST_STEPS):
        state = _concentrated(grouped, state, [*key, "start"])
    rest = [c for c in state.columns if c not in (*key, "start")]
    best = state.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct("det", "start")).alias("e"))
    active = staged(best.select(*key, "e.*"), "state")
    done = None
    # Every round lowers some determinant, and the floors bound them from below.
    while not active.isEmpty():
        before = active.select(*key, F.col("det").alias("before"))
        step = _concentrated(grouped, active, key).join(before, key)
        falls = F.col("det") < F.col("before") - SETTLED
        settled = active.join(step.where(~falls).select(*key), key, "left_semi")
        done = settled if done is None else done.unionByName(settled)
        active = staged(step.where(falls).drop("before"), "state")
    if done is None:
        names = [f"m{i}" for i in AXES] + [f"l{i}{j}" for i, j in pairs]
        return points.select("lang", "source", *[F.lit(0.0).alias(n) for n in names])
    final = staged(done, "settled")
    median = _with_distance(_salted(grouped, final, key)).groupBy(*key).agg(
        F.percentile_approx("d", 0.5, 10_000).alias("median"), F.count(F.lit(1)).alias("n")
    )
    scale = F.greatest(F.col("median") / MEDIAN, F.lit(1.0))
    own = staged(
        final.join(median, key).select(
            *key,
            "n",
            *[f"m{i}" for i in AXES],
            *[(scale * F.col(f"c{i}{j}")).alias(f"c{i}{j}") for i, j in pairs],
        ),
        "scaled",
    )
    names = [f"m{i}" for i in AXES] + [f"c{i}{j}" for i, j in pairs]
    # One row: the estimate of all rows.
    top = own.where("level = 0").first()
    wide = {n: F.lit(PRIOR**2 if n[0] == "c" and n[1] == n[2] else 0.0) for n in names}
    wide.update({f"m{i}": F.lit(top[f"m{i}"]) for i in AXES})
    whole = _drawn({n: F.lit(top[n]) for n in names}, wide, F.lit(top["n"]))
    columns = {n: F.col(n) for n in names}
    by_lang = own.where("level = 1").select(
        "g1", *[c.alias(f"__{n}") for n, c in _drawn(columns, whole, F.col("n")).items()]
    )
    drawn = _drawn(columns, {n: F.col(f"__{n}") for n in names}, F.col("n"))
    moments = own.where("level = 2").join(by_lang, "g1").select(
        F.col("g1").alias("lang"), F.col("g2").alias("source"), *[c.alias(n) for n, c in drawn.items()]
    )
    used = ["lang", "source"] + [f"m{i}" for i in AXES] + [f"l{i}{j}" for i, j in pairs]
    return staged(_factored(staged(moments, "drawn")).select(*used), "estimates")


def judge(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``base_failed``, ``distance`` and ``kept`` beside the columns of ``rows``, a stored table."""
    s = F.col("__s")
    xs = [x.alias(f"x{i}") for i, x in zip(AXES, vector(s), strict=True)]
    sites = estimates.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    sites = sites.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = (
        (F.col("lang") == F.col("__lang"))
        & (F.col("source") == F.col("__source"))
        & (F.col("salt") == F.col("__salt"))
    )
    far = _with_distance(rows.select("*", *xs, _salt()).join(sites, same, "left"))
    failed = base_failed(s)
    return far.select(
        *[f"`{c}`" for c in rows.columns],
        failed.alias("base_failed"),
        F.col("d").alias("distance"),
        (~failed & F.coalesce(F.col("d") <= CUTOFF, F.lit(True))).alias("kept"),
    )


def robust_outliers(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """Documents with ``__s``, base_failed, distance and kept; columns are all kept.

    The statistics are staged beside the caller's columns (a struct ``row``), so they
    are computed once and texts are never joined by an id.
    """
    rows = with_statistics(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            _site(lang_col).alias("lang"),
            _site(source_col).alias("source"),
            F.col(text_col).cast("string").alias("text"),
        )
    ).drop("text")
    rows = staged(rows, "statistics")
    return judge(rows, fit(rows.select("lang", "source", "__s")))


def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = with_statistics(
        docs.select("doc_id", _site("lang").alias("lang"), _site("source").alias("source"), "text")
    ).drop("text")
    rows = staged(rows, "statistics")
    return judge(rows, fit(rows)).select(
        "doc_id",
        *[F.col("__s")[n].alias(n) for n in STATS[:5]],
        "base_failed",
        "kept",
        "distance",
    )
