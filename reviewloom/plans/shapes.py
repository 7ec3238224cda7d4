"""Plan shapes used by many operators: keep-first, stored tables, exact cuts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import materialise, scratch_path

# A side is only hinted for broadcast when it is known to have at most this
# many (narrow) rows; anything bigger keeps the shuffle join Spark would pick.
BROADCAST_ROWS = 200_000


def col(name: str) -> Column:
    """Column by exact name, also when the name contains dots."""
    return F.col(f"`{name}`")


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> None:
    """Analysis-time schema check; runs no job."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; it has {df.columns}")


def first_present(columns: Sequence[str], candidates: Iterable[str]) -> str | None:
    """The first candidate that exists in ``columns``."""
    return next((name for name in candidates if name in columns), None)


def row_digest(names: Sequence[str]) -> Column:
    """SHA-256 over the named values; NULL and '' stay apart.

    Grouping on 32 bytes keeps wide text out of the shuffle key and out of the
    sort comparisons.
    """
    # The default format of timestamps would stop at milliseconds.
    exact = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return F.unhex(F.sha2(F.to_json(F.struct(*[col(n) for n in names]), exact), 256))


def _keep_first_by_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key by an aggregate over whole rows; needs nothing of ``order``."""
    rest = [n for n in df.columns if n not in keys and n != order]
    picked = (
        df.groupBy(row_digest(keys).alias("__digest"))
        .agg(
            F.min_by(
                F.struct(*[col(n) for n in keys], *[col(n) for n in rest]),
                # A missing order value comes last, not nowhere.
                F.struct(col(order).isNull(), col(order)),
            ).alias("__row"),
            F.min(col(order)).alias(order),
        )
        .drop("__digest")
    )
    return picked.select(
        *[
            col(n) if n == order else F.col("__row").getField(n).alias(n)
            for n in df.columns
        ]
    )


def keep_first(
    df: DataFrame, keys: Sequence[str], order: str = "review_id", dear: bool = False
) -> DataFrame:
    """One full row per key: the one with the smallest ``order`` value.

    Two phases, the first of which runs when this is called.  It reduces (digest,
    order) pairs to the first order of each digest and stores the orders that lose, so
    only 40 bytes a row are dealt, and a key that holds a third of the table collapses
    on the map side.  The second reads the rows again and leaves out the losers where
    they stand: wide rows are neither dealt nor sorted, except those a Bloom filter of
    the losers points at when these are too many to broadcast.

    As rows are read twice, ``dear`` stores them first, where they are: for rows that cost
    more to compute than to write.

    Values of ``order`` that repeat or are missing cannot name a row; tables with such
    values take the aggregate over whole rows instead, with the same result.
    """
    df = stored(df, "rows") if dear else df
    kind = dict(df.dtypes)[order]
    narrow = df.select(row_digest(keys).alias("__digest"), col(order).alias("__order"))
    narrow = materialise(narrow)
    firsts = narrow.groupBy("__digest").agg(F.min("__order").alias("__first"))
    named = narrow.groupBy("__order").agg(F.count(F.lit(1)).alias("__n"))
    marks = named.join(
        firsts.select(F.col("__first").alias("__order"), F.lit(True).alias("__stays")), "__order", "left"
    )
    odd = (F.col("__n") > 1) | F.col("__order").isNull()
    marks = materialise(
        marks.where(odd | F.col("__stays").isNull()).select("__order", odd.alias("__odd"))
    )
    found = marks.agg(F.count(F.lit(1)).alias("n"), F.max("__odd").alias("odd")).first()
    if found["odd"] or kind in ("float", "double"):
        return _keep_first_by_rows(df, keys, order)
    losers = marks.select(F.col("__order").alias(order))
    if found["n"] == 0:
        return df
    if found["n"] <= BROADCAST_ROWS:
        return df.join(F.broadcast(losers), order, "left_anti").select(*[col(n) for n in df.columns])
    suspect = bloom_test(losers, order, found["n"])
    held = df.where(suspect).join(losers, order, "left_anti")
    return df.where(~suspect).unionByName(held.select(*[col(n) for n in df.columns]))


BLOOM_HASHES = 4
MOST_BLOOM_BITS = 1 << 26  # 8 MB


def bloom_test(keys: DataFrame, name: str, n: int) -> Column:
    """A condition on column ``name`` that holds for every value in ``keys`` (a one-column
    table of about ``n`` rows) and for few others.

    The filter is one array of at most 8 MB whatever ``n`` is; beyond some ten million
    keys it lets more of the others through.
    """
    bits = 1 << 12
    while bits < 10 * n and bits < MOST_BLOOM_BITS:
        bits *= 2

    def positions(value: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(F.lit(i), value), F.lit(bits)).cast("bigint") for i in range(BLOOM_HASHES)
        ]

    def word(position: Column) -> Column:
        return F.floor(position / 64).cast("int")

    def mask(position: Column) -> Column:
        return F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), F.pmod(position, F.lit(64)).cast("int")
        )

    set_words = (
        keys.select(F.explode(F.array(*positions(col(name)))).alias("p"))
        .groupBy(word(F.col("p")).alias("w"))
        .agg(F.bit_or(mask(F.col("p"))).alias("bits"))
    )
    # At most MOST_BLOOM_BITS / 64 rows by construction.
    every = keys.sparkSession.range(bits // 64).select(
        F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("bits")
    )
    dense = set_words.unionByName(every).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    filter_ = materialise(
        dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x.bits).alias("words"))
    )
    words = filter_.scalar()
    tests = [
        F.get(words, word(p)).bitwiseAND(mask(p)) != 0 for p in positions(F.col(f"`{name}`"))
    ]
    held = tests[0]
    for test in tests[1:]:
        held = held & test
    return F.coalesce(held, F.lit(True))


def duplicate_count(df: DataFrame, keys: Sequence[str], alias: str = "duplicate_rows") -> DataFrame:
    """Rows beyond the first of each key, as a one-row table."""
    return (
        df.groupBy(row_digest(keys).alias("__digest"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias(alias))
    )


def stored(df: DataFrame, name: str = "table", **options) -> DataFrame:
    """A reduced table (per topic, label or model) computed once, in the shared folder.

    What reads it sees its size in bytes, so Spark broadcasts it where it is small and
    shuffles it where it is not; nothing passes through the driver, and the plan is made
    the same way at every size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW_GROUP = 16 * 1024 * 1024


def stored_wide(df: DataFrame, name: str) -> DataFrame:
    """Texts or vectors of all rows, computed once and read by several passes.

    As files they take no memory beside a row group a task, whatever their number; a cached
    table fills the executors, and its blocks are built in memory beside those kept.
    """
    return stored(df, name, **{"parquet.block.size": ROW_GROUP, "compression": "zstd"})


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """Give a table scan that has fewer splits than cores one part per core.

    Text work is heavy for its bytes; scans with enough splits stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def literal_rows(spark, rows, schema: str) -> DataFrame:
    """A fixed table from program constants, planned as a local relation."""
    return spark.createDataFrame(list(rows), schema)


def weighted_percentiles(
    df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles from a value histogram.

    Counting per distinct value first means the final aggregate sees one row per
    distinct value, not one per input row.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    aggs = [
        F.percentile(F.col(value), F.lit(p), F.col("__n")).alias(f"p{int(p * 100)}")
        for p in fractions
    ]
    return counts.groupBy(*by).agg(*aggs) if by else counts.agg(*aggs)


SMALL_BUCKET = 10_000  # rows among which a boundary is found by ranking them
PREFIX_STEP = 3  # hex digits more in each round: 4,096 counts per boundary


def _boundaries(narrow: DataFrame, targets: list[tuple]) -> list[tuple]:
    """(group, cut, hash, order) of the row at each target's position.

    ``narrow`` has (__g, __h, __k); a target is (group, cut, prefix, position, rows): the
    position counts within the rows of the group whose hash starts with the prefix.
    Each round counts rows by a longer prefix, until few rows share it.
    """
    spark = narrow.sparkSession
    kind = dict(narrow.dtypes)["__g"]
    schema = f"__g {kind}, cut int, prefix string, position bigint, n bigint"
    done = []
    while targets:
        length = len(targets[0][2])
        large = [t for t in targets if t[4] > SMALL_BUCKET and length < 32]
        small = [t for t in targets if not (t[4] > SMALL_BUCKET and length < 32)]
        if small:
            # A bucket of one full hash holds one order value, so any of its rows will do.
            side = F.broadcast(spark.createDataFrame(small, schema).alias("t"))
            same = F.col("t.__g").eqNullSafe(narrow["__g"]) & (
                F.substring("__h", 1, length) == F.col("t.prefix")
            )
            held = narrow.join(side, same)
            if length < 32:
                rank = F.row_number().over(Window.partitionBy("t.__g", "cut").orderBy("__h", "__k"))
                held = held.withColumn("rank", rank).where("rank = position")
            chosen = held.groupBy("t.__g", "cut").agg(F.max(F.struct("__h", "__k")).alias("b"))
            done += [(r[0], r["cut"], r["b"]["__h"], r["b"]["__k"]) for r in chosen.collect()]
        if not large:
            break
        step = min(32, length + PREFIX_STEP)
        side = F.broadcast(spark.createDataFrame(large, schema).alias("t"))
        same = F.col("t.__g").eqNullSafe(narrow["__g"]) & (
            F.substring("__h", 1, length) == F.col("t.prefix")
        )
        counts = (
            narrow.join(side, same)
            .groupBy(F.col("t.__g").alias("__g"), "cut", "position", F.substring("__h", 1, step).alias("longer"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        upto = F.sum("rows").over(Window.partitionBy("__g", "cut").orderBy("longer"))
        hit = counts.withColumn("upto", upto).where(
            (F.col("upto") >= F.col("position")) & (F.col("upto") - F.col("rows") < F.col("position"))
        )
        targets = [
            (r["__g"], r["cut"], r["longer"], r["position"] - (r["upto"] - r["rows"]), r["rows"])
            for r in hit.collect()
        ]
    return done


def split_by_hash(
    df: DataFrame,
    group: str,
    cuts,
    rest: str,
    seed: int,
    order: str = "review_id",
    output: str = "split",
) -> DataFrame:
    """Exact seeded quotas inside every group, told by two comparisons per row.

    Rows are ordered by (md5(seed:id), id); ``cuts`` maps a group's total to
    [(name, end position), ...] and rows past the last cut get ``rest``.  The row at each
    end is searched for when this is called: rounds of counts per hash prefix over
    (group, id) pairs narrow the search to a few thousand rows, which are ranked.  The
    result reads ``df`` once and shuffles nothing.  Rows of one id cannot be parted, so
    repeated ids may exceed a quota; rows without id come first.
    """
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), col(order).cast("string")))
    key = F.coalesce(hashed, F.lit(""))
    narrow = materialise(df.select(col(group).alias("__g"), key.alias("__h"), col(order).alias("__k")))
    totals = narrow.groupBy("__g").agg(F.count(F.lit(1)).alias("n"))
    ends = cuts(F.col("n"))
    names = [name for name, _ in ends]
    found = totals.select(
        "__g", "n", *[end.cast("bigint").alias(f"end{i}") for i, (_, end) in enumerate(ends)]
    ).limit(BROADCAST_ROWS + 1).collect()
    if len(found) > BROADCAST_ROWS:
        raise ValueError(f"more than {BROADCAST_ROWS} groups to split")
    targets = [
        (r["__g"], i, "", r[f"end{i}"], r["n"])
        for r in found
        for i in range(len(names))
        if r[f"end{i}"] > 0
    ]
    bounds: dict = {r["__g"]: [None] * (2 * len(names)) for r in found}
    for g, cut, h, k in _boundaries(narrow, targets):
        bounds[g][2 * cut : 2 * cut + 2] = [h, k]
    types = dict(narrow.dtypes)
    fields = "".join(f", __h{i} string, __k{i} {types['__k']}" for i in range(len(names)))
    side = df.sparkSession.createDataFrame(
        [(g, *b) for g, b in bounds.items()], f"__g {types['__g']}{fields}"
    )
    # One row per group, counted above.
    joined = df.withColumn("__h", key).join(
        F.broadcast(side), F.col("__g").eqNullSafe(col(group)), "left"
    )
    chosen = None
    for i, name in enumerate(names):
        before = (F.col("__h") < F.col(f"__h{i}")) | (
            (F.col("__h") == F.col(f"__h{i}"))
            & F.coalesce(col(order) <= F.col(f"__k{i}"), F.lit(True))
        )
        chosen = F.when(before, name) if chosen is None else chosen.when(before, name)
    return joined.select(*[col(n) for n in df.columns], chosen.otherwise(rest).alias(output))
