"""Topic model: randomised SVD, batched K-Means, silhouette, topic tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom import settings as S
from reviewloom.functions import text as X
from reviewloom.functions.blocks import (
    CELLS,
    DENSE_ROWS,
    add_matrices,
    fit_partitions,
    flat_chunks,
    flat_lists,
    flatten_sparse,
    lists_of,
    matrix_of,
    rows_times,
    size_of,
    small_batches,
    sparse_chunks,
    stack,
)
from reviewloom.functions.vectors import sum_vectors
from reviewloom.operators.vectorize import TermWeights, counted_terms, fit_terms, unit_weights, vectorise
from reviewloom.plans.shapes import col, require_columns, stored_wide


# --- truncated SVD -------------------------------------------------------------


def valid_components(n_rows: int, n_terms: int, requested: int) -> int:
    k = min(requested, n_rows - 1, n_terms - 1)
    if k < 2:
        raise ValueError(f"SVD needs two components; the matrix is {n_rows} x {n_terms}")
    return k


def _sparse_parts(df: DataFrame, features: str) -> DataFrame:
    return df.select(f"{features}.indices", f"{features}.values")


def _gram_times(df: DataFrame, basis: np.ndarray, parts: int) -> np.ndarray:
    """AᵀA·Q in one pass over the rows of A."""
    shared = df.sparkSession.sparkContext.broadcast(basis)

    def work(batches):
        q = shared.value
        total = np.zeros(q.shape)
        for batch in batches:
            for _, forward, backward in sparse_chunks(batch["indices"], batch["values"], len(q)):
                total += backward(forward(q))
        return total

    image = add_matrices(df, work, *basis.shape, parts)
    shared.destroy()
    return image


def _fix_signs(v: np.ndarray) -> np.ndarray:
    """Make the largest loading of every component positive."""
    largest = v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]
    return v * np.where(largest < 0, -1.0, 1.0)


def truncated_svd(
    df: DataFrame,
    n_terms: int,
    components: int = S.SVD_COMPONENTS,
    features: str = "features",
    seed: int = S.RANDOM_SEED,
    max_passes: int = 8,
    oversample: int = 10,
    settled: float = 0.02,
) -> np.ndarray:
    """Right singular vectors (n_terms x k) of the uncentred matrix.

    Block Krylov iteration on AᵀA: a pass over the data, one Spark job, maps the newest
    block; all blocks so far are kept, and the answer is the best subspace of dimension k
    inside their span.  Passes end when that subspace has turned by less than ``settled``
    (mean squared sine of the angles) since the pass before.  The driver holds at most
    n_terms x (max_passes x block) numbers, a block being half of k and a few more.
    """
    n_rows, n_parts, entries = size_of(df, F.size(f"{features}.indices"))
    k = valid_components(n_rows, n_terms, components)
    width = min(k // 2 + oversample, n_terms)
    block, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))
    parts, n_parts = fit_partitions(_sparse_parts(df, features), n_parts, entries * width, 2e7)
    span, image, best = np.zeros((n_terms, 0)), np.zeros((n_terms, 0)), None
    for _ in range(max_passes):
        mapped = _gram_times(parts, block, n_parts)
        span, image = np.hstack([span, block]), np.hstack([image, mapped])
        inner = span.T @ image
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        found = span @ vectors[:, np.argsort(values)[::-1][:k]]
        if best is not None and best.shape == found.shape:
            turned = 1.0 - ((best.T @ found) ** 2).sum() / found.shape[1]
            if turned < settled:
                best = found
                break
        best = found
        room = n_terms - span.shape[1]
        if room <= 0:
            break
        # Twice, as one pass of projection leaves rounding behind.
        fresh = mapped
        for _ in range(2):
            fresh = fresh - span @ (span.T @ fresh)
        block, triangle = np.linalg.qr(fresh[:, : min(width, room)])
        alive = np.abs(np.diag(triangle)) > 1e-10 * max(1.0, np.abs(triangle).max(initial=0.0))
        block = block[:, alive]
        if not block.shape[1]:
            break
    return _fix_signs(best)


def svd_residuals(df: DataFrame, basis: np.ndarray, features: str = "features") -> DataFrame:
    """(component, singular_value, residual): how far each component is from being one.

    The residual is |AᵀA v - s² v| / s², from one pass over the rows.
    """
    _, n_parts, _ = size_of(df)
    image = _gram_times(_sparse_parts(df, features), basis, n_parts)
    squared = (basis * image).sum(axis=0)
    gaps = np.linalg.norm(image - basis * squared, axis=0) / np.where(squared > 0, squared, 1.0)
    rows = [(i, float(np.sqrt(max(s, 0.0))), float(g)) for i, (s, g) in enumerate(zip(squared, gaps), 1)]
    return df.sparkSession.createDataFrame(rows, "component int, singular_value double, residual double")


def release(assigned: DataFrame) -> None:
    """Forget what is cached for a fit whose rows are not needed any more."""
    assigned.sparkSession.catalog.clearCache()


def _unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length in place; zero rows stay zero."""
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norms, out=x, where=norms > 0)


def project(
    df: DataFrame,
    basis: np.ndarray,
    features: str = "features",
    output: str = "lsa",
    normalise: bool = True,
) -> DataFrame:
    """Rows projected on the components, scaled to unit length (zero rows stay zero)."""
    shared = df.sparkSession.sparkContext.broadcast(basis)

    @F.pandas_udf("array<double>")
    def apply(indices: pd.Series, values: pd.Series) -> pd.Series:
        q = shared.value
        chunks = [forward(q) for _, forward, _ in sparse_chunks(indices, values, len(q))]
        out = np.vstack(chunks) if chunks else np.zeros((0, q.shape[1]))
        return pd.Series(list(_unit_rows(out) if normalise else out))

    return df.withColumn(output, apply(f"{features}.indices", f"{features}.values"))


def explained_variance_ratio(df: DataFrame, basis: np.ndarray, features: str = "features") -> float:
    """Variance of the projected columns over variance of the TF-IDF columns, in one pass."""
    n, n_parts, _ = size_of(df)
    terms, k = basis.shape
    shared = df.sparkSession.sparkContext.broadcast(basis)

    def work(batches):
        q = shared.value
        total = np.zeros((terms + k, 2))
        for batch in batches:
            _, cols, values, _ = flatten_sparse(batch["indices"], batch["values"])
            total[:terms, 0] += np.bincount(cols, weights=values, minlength=terms)
            total[:terms, 1] += np.bincount(cols, weights=values * values, minlength=terms)
            for _, forward, _ in sparse_chunks(batch["indices"], batch["values"], terms):
                projected = forward(q)
                total[terms:, 0] += projected.sum(axis=0)
                total[terms:, 1] += (projected**2).sum(axis=0)
        return total

    sums = add_matrices(_sparse_parts(df, features), work, terms + k, 2, n_parts)
    variance = sums[:, 1] / n - (sums[:, 0] / n) ** 2
    whole = variance[:terms].sum()
    return float(variance[terms:].sum() / whole) if whole > 0 else 0.0


def plane_coordinates(df: DataFrame, vector: str = "lsa", keep: Iterable[str] = ("review_id", "cluster_id")) -> DataFrame:
    """Two SVD coordinates of dense rows, from the exact d x d Gram matrix."""

    width = len(df.select(vector).first()[0])
    _, n_parts, _ = size_of(df)

    def work(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = stack(batch[vector])
            if len(x):
                total += x.T @ x
        return total

    _, vectors = np.linalg.eigh(add_matrices(df.select(vector), work, width, width, n_parts))
    axes = _fix_signs(vectors[:, ::-1][:, :2])

    def dot(i: int) -> Column:
        weights = F.array(*[F.lit(float(w)) for w in axes[:, i]])
        return F.aggregate(
            F.zip_with(vector, weights, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
        )

    return df.select(*keep, dot(0).alias("component_1"), dot(1).alias("component_2"))


# --- K-Means ---------------------------------------------------------------------


def _spread_start(points: np.ndarray, weights: np.ndarray, k: int, rng) -> np.ndarray:
    """k-means++ start: points drawn by weight and squared distance to those drawn."""
    chosen = [points[rng.choice(len(points), p=weights / weights.sum())]]
    nearest = ((points - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        mass = nearest * weights
        # Fewer different points than centroids: the rest repeat, and stay empty.
        share = mass / mass.sum() if mass.sum() > 0 else None
        chosen.append(points[rng.choice(len(points), p=share)])
        nearest = np.minimum(nearest, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _dense_slices(rows: pd.Series, n_centres: int):
    """(place, matrix) of a batch of dense rows, as many at a time as make CELLS distances:
    those of a whole batch to the centroids of many models would take gigabytes."""
    step = max(1, min(DENSE_ROWS, CELLS // n_centres))
    for at in range(0, len(rows), step):
        yield at, stack(rows.iloc[at : at + step])


def _gaps_to(models: list[np.ndarray]):
    """Function from rows to |c|² - 2x·c for the centroids c of all models, side by side."""
    centres = np.vstack(models)
    lengths, doubled = (centres**2).sum(axis=1), -2.0 * centres.T

    def gaps(x: np.ndarray) -> np.ndarray:
        found = x @ doubled
        found += lengths
        return found

    return gaps


def _far_rows(
    df: DataFrame, vector: str, key: str, models: list[np.ndarray], rates: np.ndarray, salt: str
) -> list[np.ndarray]:
    """Per model, rows drawn with probability squared distance x the model's rate.

    A row's draw depends on its key, the salt and the model, so a task run again
    draws the same rows.
    """
    shared = df.sparkSession.sparkContext.broadcast((models, rates))

    def work(batches):
        centres, rate = shared.value
        measure = _gaps_to(centres)
        starts = np.cumsum([0] + [len(c) for c in centres])[:-1]
        salts = np.arange(1, len(centres) + 1, dtype=np.int64) * np.int64(0x9E3779B97F4A7)
        for batch in batches:
            hashes = batch["h"].to_numpy().astype(np.int64)
            for at, x in _dense_slices(batch[vector], sum(map(len, centres))):
                nearest = np.minimum.reduceat(measure(x), starts, axis=1)
                distance = np.maximum(nearest + (x**2).sum(axis=1)[:, None], 0.0)
                mixed = (hashes[at : at + len(x), None] ^ salts).view(np.uint64)
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
                draw = (mixed ^ (mixed >> np.uint64(31))).astype(np.float64) / 2.0**64
                row, model = np.nonzero(draw < distance * rate)
                if len(row):
                    yield pd.DataFrame({"model": model, "x": pd.Series(list(x[row]), dtype=object)})

    hashed = df.select(vector, F.xxhash64(F.lit(salt), F.col(key)).alias("h"))
    # About OVERSAMPLING x k rows a model, whatever the size of the table.
    with small_batches(df.sparkSession):
        found = hashed.mapInPandas(work, "model int, x array<double>").orderBy("model", "x").toArrow()
    shared.destroy()
    owner = found["model"].to_numpy()
    rows = np.array(found["x"].to_pylist()).reshape(len(owner), models[0].shape[1])
    return [rows[owner == i] for i in range(len(models))]


OVERSAMPLING = 2
START_ROUNDS = 4


def _start_centroids(
    df: DataFrame, vector: str, key: str, plan: list[tuple[int, int]], seed: int, parts: int
) -> list[np.ndarray]:
    """k-means|| over all rows, for all (k, restart) together.

    From one row a restart, rounds draw rows in proportion to their squared
    distance; each drawn row is weighed by the rows nearest to it, and k-means++
    reduces them to k.
    """
    restarts = sorted({r for _, r in plan})
    firsts = df.agg(
        *[
            F.min_by(vector, F.struct(F.xxhash64(F.lit(f"{seed}:{r}"), F.col(key)), F.col(key))).alias(f"r{r}")
            for r in restarts
        ]
    ).first()
    models = [np.array([firsts[f"r{r}"]]) for _, r in plan]
    for turn in range(START_ROUNDS):
        costs = np.array([s[:, 1].sum() for s in _lloyd_pass(df, vector, models, parts, sums=False)])
        wanted = np.array([OVERSAMPLING * k for k, _ in plan], dtype=float)
        rates = np.divide(wanted, costs, out=np.zeros(len(plan)), where=costs > 0)
        drawn = _far_rows(df, vector, key, models, rates, f"{seed}:start:{turn}")
        models = [np.vstack([m, d]) if len(d) else m for m, d in zip(models, drawn, strict=True)]
    starts = []
    for (k, r), points, stats in zip(
        plan, models, _lloyd_pass(df, vector, models, parts, sums=False), strict=True
    ):
        starts.append(_spread_start(points, stats[:, 0], k, np.random.default_rng([seed, k, r])))
    return starts


def _lloyd_pass(
    df: DataFrame, vector: str, models: list[np.ndarray], parts: int, sums: bool = True
) -> list[np.ndarray]:
    """One pass for all models at once: per centroid [count, squared distance, sums...].

    Without ``sums``, counts and squared distances only.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)
    edges = np.cumsum([0] + [len(m) for m in models])
    width = models[0].shape[1] + 2 if sums else 2

    def work(batches):
        measure = _gaps_to(shared.value)
        n = int(edges[-1])
        total = np.zeros((n, width))
        for batch in batches:
            for _, x in _dense_slices(batch[vector], n):
                gaps = measure(x)
                at = np.arange(len(x))[:, None]
                nearest = np.column_stack(
                    [a + gaps[:, a:b].argmin(axis=1) for a, b in zip(edges[:-1], edges[1:])]
                )
                far = np.maximum(gaps[at, nearest] + (x**2).sum(axis=1)[:, None], 0.0)
                total[:, 0] += np.bincount(nearest.ravel(), minlength=n)
                total[:, 1] += np.bincount(nearest.ravel(), weights=far.ravel(), minlength=n)
                if sums:
                    member = np.zeros((len(x), n))
                    member[at, nearest] = 1.0
                    total[:, 2:] += member.T @ x
        return total

    flat = add_matrices(df.select(vector), work, int(edges[-1]), width, parts)
    shared.destroy()
    return [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]


def kmeans(
    df: DataFrame,
    cluster_counts: Iterable[int],
    vector: str = "lsa",
    restarts: int = S.KMEANS_RESTARTS,
    seed: int = S.RANDOM_SEED,
    max_iter: int = 300,
    tol: float = 1e-4,
    key: str = "review_id",
) -> dict[int, tuple[np.ndarray, float]]:
    """Best centroids and inertia per k over all restarts.

    Starts and tolerance come from all rows.  Every restart of every k advances in
    the same pass, so a sweep costs as many jobs as its slowest member, not the
    sum.  ``df`` should be cached.
    """
    n_rows, n_parts, _ = size_of(df)
    plan = [(int(k), r) for k in cluster_counts for r in range(restarts)]
    live = list(range(len(plan)))
    width = len(df.select(vector).first()[0])
    flops = n_rows * width * sum(k for k, _ in plan)
    rows, n_parts = fit_partitions(df.select(key, vector), n_parts, flops, 4e8)
    # Measured from the origin, one pass gives the mean and the mean square.
    whole = _lloyd_pass(rows, vector, [np.zeros((1, width))], n_parts)[0][0]
    variance = whole[1] / n_rows - ((whole[2:] / n_rows) ** 2).sum()
    spread = max(float(variance), 0.0) / width * tol
    models = _start_centroids(rows, vector, key, plan, seed, n_parts)
    for _ in range(max_iter):
        moved = []
        for i, stats in zip(live, _lloyd_pass(rows, vector, [models[i] for i in live], n_parts)):
            counts = stats[:, :1]
            updated = np.where(counts > 0, stats[:, 2:] / np.maximum(counts, 1), models[i])
            if ((updated - models[i]) ** 2).sum() > spread:
                moved.append(i)
            models[i] = updated
        live = moved
        if not live:
            break
    best: dict[int, tuple[np.ndarray, float]] = {}
    for (k, _), centres, stats in zip(plan, models, _lloyd_pass(rows, vector, models, n_parts)):
        inertia = float(stats[:, 1].sum())
        if k not in best or inertia < best[k][1]:
            best[k] = (centres, inertia)
    return best


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    gaps = (centres**2).sum(axis=1) - 2.0 * (points @ centres.T)
    return gaps.argmin(axis=1)


def centroid_distances(vector: Column, centres: np.ndarray) -> Column:
    """Array of Euclidean distances of a row to every centroid."""

    @F.pandas_udf("array<double>")
    def distances(rows: pd.Series) -> pd.Series:
        # One difference for each number of a row and each centroid.
        found = [_gaps(x, centres) for _, x in _dense_slices(rows, centres.size)]
        return pd.Series([gaps for part in found for gaps in part], dtype=object)

    return distances(vector)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to centroids."""
    return np.sqrt(((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))


def assign(df: DataFrame, centres: np.ndarray, vector: str = "lsa") -> DataFrame:
    """Nearest centroid and the distance to it."""
    found = df.withColumn("__d", centroid_distances(F.col(vector), centres))
    return found.withColumns(
        {
            "cluster_id": (F.array_position("__d", F.array_min("__d")) - 1).cast("int"),
            "distance_to_centroid": F.array_min("__d"),
        }
    ).drop("__d")


def all_distances(df: DataFrame, centres: np.ndarray, vector: str, key: str) -> DataFrame:
    """(key, cluster_id, distance) for every row and every centroid."""
    return df.select(
        key, F.posexplode(centroid_distances(F.col(vector), centres)).alias("cluster_id", "distance")
    )


def group_centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(label, n, centre): mean vector per label, summed on the map side."""
    dense = F.concat(F.array(F.lit(1.0)), F.transform(vector, lambda x: x.cast("double")))
    summed = sum_vectors(df.select(label, dense.alias("sums")), label, "sums")
    count = F.element_at("sums", 1)
    centre = F.transform(F.slice("sums", F.lit(2), F.size("sums") - 1), lambda x: x / count)
    return summed.select(label, count.cast("bigint").alias("n"), centre.alias("centre"))


# Labels of a clustering whose statistics (one vector each) are shared with the tasks.
MOST_CLUSTERS = 10_000

# --- silhouette ------------------------------------------------------------------


def silhouette(
    df: DataFrame,
    vector: str = "lsa",
    label: str = "cluster_id",
    key: str = "review_id",
    sample_size: int = S.SILHOUETTE_SAMPLE,
    seed: int = S.RANDOM_SEED,
) -> DataFrame:
    """Mean Euclidean silhouette over a seeded sample, as one row.

    NULL when fewer than two labels, or when every row is its own cluster.
    """
    picked = _sampled(df.select(key, vector, label), key, sample_size, seed).persist()
    labels = np.array([r[0] for r in picked.select(label).collect()])
    points = matrix_of(picked, vector)
    picked.unpersist()
    return _silhouette_rows(df.sparkSession, points, {0: labels}).drop("k")


def silhouette_of_all(df: DataFrame, vector: str = "lsa", label: str = "cluster_id") -> DataFrame:
    """Mean silhouette of squared Euclidean distances over all rows, as one row.

    The mean squared distance of a point to a cluster follows from the cluster's size,
    vector sum and sum of squared lengths, so two passes replace all pairs of rows: one
    aggregate per label, and one scan that scores each row against those aggregates.
    Rows without vector or label take no part.  NULL when there are fewer than two
    labels, or when every row is its own cluster; a row alone in its cluster scores 0.
    """
    rows = df.select(label, vector).where(col(vector).isNotNull() & col(label).isNotNull())
    dense = F.transform(vector, lambda x: x.cast("double"))
    square = F.aggregate(dense, F.lit(0.0), lambda acc, x: acc + x * x)
    totals = sum_vectors(
        rows.select(label, F.concat(F.array(F.lit(1.0), square), dense).alias("sums")), label, "sums"
    )
    found = totals.limit(MOST_CLUSTERS + 1).collect()
    if len(found) > MOST_CLUSTERS:
        raise ValueError(f"more than {MOST_CLUSTERS} clusters")
    place = {r[label]: i for i, r in enumerate(found)}
    sums = np.array([r["sums"] for r in found] or [[0.0]], dtype=float)
    schema = "rows bigint, clusters bigint, silhouette double"
    n_rows = int(sums[:, 0].sum())
    if len(found) < 2 or (sums[:, 0] < 2).all():
        return df.sparkSession.createDataFrame([(n_rows, len(found), None)], schema)

    @F.pandas_udf("double")
    def scores(labels: pd.Series, vectors: pd.Series) -> pd.Series:
        own = labels.map(place).to_numpy(dtype=np.int64)
        x = stack(vectors)
        if len(x) == 0:
            return pd.Series([], dtype=float)
        size, squares, centre = sums[:, 0], sums[:, 1], sums[:, 2:]
        # Sum of squared distances of each row to all members of each cluster.
        gaps = (x**2).sum(axis=1)[:, None] * size - 2.0 * (x @ centre.T) + squares
        gaps = np.maximum(gaps, 0.0)
        here = np.arange(len(x))
        a = gaps[here, own] / np.maximum(size[own] - 1, 1)
        means = gaps / size
        means[here, own] = np.inf
        b = means.min(axis=1)
        peak = np.maximum(a, b)
        fair = (size[own] > 1) & (peak > 0)
        return pd.Series(np.where(fair, (b - a) / np.where(peak > 0, peak, 1.0), 0.0))

    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(found)).cast("bigint").alias("clusters"),
        F.avg(scores(col(label), col(vector))).alias("silhouette"),
    )


def _sampled(df: DataFrame, key: str, sample_size: int, seed: int) -> DataFrame:
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("h", order).orderBy("h", key).limit(sample_size)


def _silhouette_rows(spark, points: np.ndarray, labelings: Mapping[int, np.ndarray]) -> DataFrame:
    """(k, sampled_rows, clusters, silhouette) for several labelings of one sample.

    The sample is shared with the tasks; each task measures a range of its rows
    against all of it, in blocks.
    """
    schema = "k int, sampled_rows bigint, clusters bigint, silhouette double"
    codes, undefined = {}, []
    for k, labels in labelings.items():
        names, code = np.unique(labels, return_inverse=True)
        if 2 <= len(names) < len(labels):
            codes[k] = code
        else:
            undefined.append((k, len(labels), len(names), None))
    missing = spark.createDataFrame(undefined, schema)
    if not codes:
        return missing
    shared = spark.sparkContext.broadcast((points, codes))

    def score(batches):
        x, labelled = shared.value
        lengths = (x**2).sum(axis=1)
        members = {k: np.eye(c.max() + 1)[c] for k, c in labelled.items()}
        for batch in batches:
            at = batch["id"].to_numpy()
            for rows in np.array_split(at, max(1, len(at) // 256)):
                here = np.arange(len(rows))
                gaps = lengths[rows, None] + lengths[None, :] - 2.0 * (x[rows] @ x.T)
                gaps = np.sqrt(np.maximum(gaps, 0.0))
                gaps[here, rows] = 0.0
                for k, code in labelled.items():
                    sizes = members[k].sum(axis=0)
                    sums, own = gaps @ members[k], code[rows]
                    a = sums[here, own] / np.maximum(sizes[own] - 1, 1)
                    means = sums / sizes
                    means[here, own] = np.inf
                    b = means.min(axis=1)
                    peak = np.maximum(a, b)
                    value = np.where(
                        (sizes[own] > 1) & (peak > 0), (b - a) / np.where(peak > 0, peak, 1), 0.0
                    )
                    yield pd.DataFrame({"k": np.int32(k), "s": value})

    scored = spark.range(len(points)).mapInPandas(score, "k int, s double")
    clusters = F.create_map(*[F.lit(v) for k, c in codes.items() for v in (int(k), int(c.max()) + 1)])
    return scored.groupBy("k").agg(
        F.count(F.lit(1)).alias("sampled_rows"), F.avg("s").alias("silhouette")
    ).select("k", "sampled_rows", clusters[F.col("k")].cast("bigint").alias("clusters"), "silhouette").unionByName(missing)


# --- the topic model ---------------------------------------------------------------


@dataclass
class TopicModel:
    """Everything needed to place a new text: vocabulary, components, centroids."""

    terms: TermWeights
    components: np.ndarray
    centres: np.ndarray
    explained_variance_ratio: float
    inertia: float
    silhouette: float | None
    seed: int
    topic_names: Mapping[int, str] | None = None

    @property
    def n_clusters(self) -> int:
        return len(self.centres)


def represent(
    df: DataFrame,
    text: str = "classical_text",
    components: int = S.SVD_COMPONENTS,
    seed: int = S.RANDOM_SEED,
    stop_words: Iterable[str] | None = None,
    key: str = "review_id",
    **bounds,
):
    """Stored TF-IDF vectors with their normalised projection, and the fitted parts.

    The projection is worked out by whoever reads it; passes over it read ``_points``.
    """
    require_columns(df, [key, text], "clustering input")
    # Stored before texts without a word go: a filter on a text that is not stored yet
    # would be pushed below the text's own work and do all of that a second time.
    texts = stored_wide(df.select(key, text), "texts").where(F.rlike(text, F.lit(X.NOT_SPACE)))
    terms = fit_terms(texts, text, stop_words, key=key, **bounds)
    with small_batches(df.sparkSession):
        vectors = stored_wide(vectorise(texts, terms, text), "vectors")
        basis = truncated_svd(vectors, len(terms.terms), components, seed=seed)
    return terms, basis, project(vectors, basis)


def _points(projected: DataFrame, key: str) -> DataFrame:
    """Key and projection of all rows, computed once."""
    with small_batches(projected.sparkSession):
        return stored_wide(projected.select(key, "lsa"), "points")


def _kmeans_of(points: DataFrame, cluster_counts: Iterable[int], restarts: int, seed: int, key: str):
    """K-Means over stored rows; those that do not fit in memory are read again in each pass."""
    points = points.persist(StorageLevel.MEMORY_ONLY)
    try:
        return kmeans(points, cluster_counts, restarts=restarts, seed=seed, key=key)
    finally:
        points.unpersist()


def sweep_cluster_counts(
    projected: DataFrame,
    basis: np.ndarray,
    cluster_counts: Iterable[int] = S.CLUSTER_COUNTS,
    restarts: int = S.KMEANS_RESTARTS,
    seed: int = S.RANDOM_SEED,
    sample_size: int = S.SILHOUETTE_SAMPLE,
    key: str = "review_id",
) -> DataFrame:
    """Inertia, silhouette and explained variance per valid k on one representation."""
    n = projected.count()
    valid = [k for k in map(int, cluster_counts) if 2 <= k < n]
    if not valid:
        raise ValueError("no valid cluster counts")
    ratio = explained_variance_ratio(projected, basis)
    points = _points(projected, key)
    models = _kmeans_of(points, valid, restarts, seed, key)
    sample = matrix_of(_sampled(points, key, sample_size, seed), "lsa")
    labelings = {k: _nearest(sample, centres) for k, (centres, _) in models.items()}
    scores = {r["k"]: r["silhouette"] for r in _silhouette_rows(projected.sparkSession, sample, labelings).collect()}
    rows = [(k, models[k][1], scores[k], basis.shape[1], ratio) for k in sorted(models)]
    return projected.sparkSession.createDataFrame(
        rows,
        "n_clusters int, inertia double, silhouette_score double, svd_components int, "
        "svd_explained_variance_ratio double",
    )


def fit_topic_model(
    df: DataFrame,
    n_clusters: int = S.N_CLUSTERS,
    text: str = "classical_text",
    components: int = S.SVD_COMPONENTS,
    restarts: int = S.KMEANS_RESTARTS,
    seed: int = S.RANDOM_SEED,
    stop_words: Iterable[str] | None = None,
    key: str = "review_id",
    sample_size: int = S.SILHOUETTE_SAMPLE,
    **bounds,
) -> tuple[TopicModel, DataFrame]:
    """The fitted model and the assigned rows (key, text, features, lsa, cluster_id, distance)."""
    if n_clusters < 2:
        raise ValueError("n_clusters must be at least 2")
    terms, basis, projected = represent(df, text, components, seed, stop_words, key, **bounds)
    if n_clusters >= projected.count():
        raise ValueError("n_clusters must be smaller than the number of texts")
    points = _points(projected, key)
    centres, inertia = _kmeans_of(points, [n_clusters], restarts, seed, key)[n_clusters]
    with small_batches(df.sparkSession):
        sampled = silhouette(assign(points, centres), key=key, sample_size=sample_size, seed=seed)
        score = sampled.first()["silhouette"]
    model = TopicModel(
        terms, basis, centres, explained_variance_ratio(projected, basis), inertia, score, seed
    )
    # One step in Python instead of a projection and distances to centroids after it.
    return model, _placed(projected.drop("lsa"), "features", model, weighed=True, keep_lsa=True)


def _placed(
    df: DataFrame, sparse: str, model: TopicModel, weighed: bool = False, keep_lsa: bool = False
) -> DataFrame:
    """Cluster and distance to its centroid, and ``lsa`` if it is kept, of sparse rows: TF-IDF
    vectors, or counts of terms unless ``weighed``.

    Weights, projection and distances are one step in Python, which works on CHUNK rows at a
    time: as steps of their own each would hold batches of its input and output.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.terms.idf, model.components, model.centres))
    kinds = {"cluster_id": "int", "distance_to_centroid": "double"}
    if keep_lsa:
        kinds = {"lsa": "array<double>", **kinds}

    @F.arrow_udf(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
    def place(indices: pa.Array, values: pa.Array) -> pa.Array:
        idf, basis, centres = shared.value
        cols, entries, ends = flat_lists(indices, values)
        cluster, distance = np.empty(len(ends), np.int32), np.empty(len(ends))
        lsa = np.empty((len(ends) if keep_lsa else 0, basis.shape[1]))
        for start, stop, first, last, rows in flat_chunks(ends):
            unit = entries[first:last]
            if not weighed:
                unit = unit_weights(cols[first:last], unit, rows, idf)
            x = _unit_rows(rows_times(rows, cols[first:last], unit, stop - start, basis))
            gaps = _gaps(x, centres)
            cluster[start:stop], distance[start:stop] = gaps.argmin(axis=1), gaps.min(axis=1)
            if keep_lsa:
                lsa[start:stop] = x
        found = {"cluster_id": pa.array(cluster), "distance_to_centroid": pa.array(distance)}
        if keep_lsa:
            found["lsa"] = lists_of(lsa.ravel(), np.arange(1, len(ends) + 1) * basis.shape[1])
        return pa.StructArray.from_arrays([found[name] for name in kinds], names=list(kinds))

    placed = df.withColumn("__p", place(f"{sparse}.indices", f"{sparse}.values"))
    return placed.withColumns({name: F.col(f"__p.{name}") for name in kinds}).drop("__p")


def predict_topics(df: DataFrame, model: TopicModel, text: str = "classical_text") -> DataFrame:
    """Cluster, distance and topic name for new texts; no shuffle."""
    placed = _placed(counted_terms(df, model.terms, text, "__s"), "__s", model).drop("__s")
    return add_topic_labels(placed, model.topic_names) if model.topic_names else placed


def add_topic_labels(df: DataFrame, names: Mapping[int, str], cluster: str = "cluster_id", topic: str = "topic_name") -> DataFrame:
    """Topic name per row; a cluster without a name fails the row's job."""
    lookup = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])
    name = F.try_element_at(lookup, F.col(cluster))
    complaint = F.concat(F.lit("no topic name for cluster "), F.col(cluster).cast("string"))
    return df.withColumn(topic, F.when(name.isNotNull(), name).otherwise(F.raise_error(complaint)))


def unnamed_clusters(df: DataFrame, names: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Clusters in use that have no entry in the names table."""
    used = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("review_count"))
    return used.join(names, cluster, "left_anti")


# --- topic tables --------------------------------------------------------------------


def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("review_count"))
    total = F.sum("review_count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percentage", F.round(F.col("review_count") / total * 100, 2))


def top_terms_of_weights(
    weights: DataFrame, sizes: DataFrame, cluster: str = "cluster_id", top_n: int = S.TOP_TERMS
) -> DataFrame:
    """Highest mean weight per cluster from (cluster, term, weight) rows.

    The mean counts reviews without the term as zero.
    """
    sums = weights.groupBy(cluster, "term").agg(F.sum("weight").alias("total"))
    means = sums.join(sizes.select(cluster, "review_count"), cluster).select(
        cluster, "term", F.round(F.col("total") / F.col("review_count"), 9).alias("mean_tfidf")
    )
    order = Window.partitionBy(cluster).orderBy(F.desc("mean_tfidf"), F.asc("term"))
    return means.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def top_terms(assigned: DataFrame, terms: TermWeights, top_n: int = S.TOP_TERMS) -> DataFrame:
    """Top terms from rows that carry their sparse vector and cluster."""
    entries = assigned.select(
        "cluster_id", F.explode(F.arrays_zip("features.indices", "features.values")).alias("e")
    )
    named = terms.table(assigned.sparkSession).select(F.col("idx"), "term")
    weights = (
        entries.select("cluster_id", F.col("e.indices").alias("idx"), F.col("e.values").alias("weight"))
        .groupBy("cluster_id", "idx")
        .agg(F.sum("weight").alias("weight"))
        .join(F.broadcast(named), "idx")  # one row per vocabulary entry, capped when fitted
    )
    return top_terms_of_weights(weights, cluster_sizes(assigned), top_n=top_n)


def nearest_to_centroid(
    df: DataFrame,
    n: int = S.REVIEWS_PER_CLUSTER,
    cluster: str = "cluster_id",
    distance: str = "distance_to_centroid",
    key: str = "review_id",
) -> DataFrame:
    """The n rows nearest to their centroid, with rank; trimmed before the shuffle."""
    order = Window.partitionBy(cluster).orderBy(F.asc(distance), F.asc(key))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
