"""Corpus operators against plain versions, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from reviewloom.llm import (
    common,
    multiindex,
    outliers,
    packing,
    pieces,
    sharding,
    simhash,
    sitequality,
    substrings,
    toxicity,
    urlrules,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int"


def documents(spark, rows):
    """Rows (id, text) with the other columns, one of a clashing name."""
    full = [(i, t, "en" if (i or 0) % 2 else None, "s", len(t or ""), 7) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows."""
    random.seed(4)
    draw = lambda n: " ".join(random.choice("abcde") for _ in range(n))
    rows = [(i, draw(random.choice([1, 2, 34, 35, 36, 80]))) for i in range(40)]
    rows += rows[:5] + [(None, None), (41, None), (42, ""), (43, " \n\t "), (None, "x y z")]
    rows += [(44, "long " * 30_000), (45, "é日🙂 " * 50), (46, "The THE the")]
    return rows


def test_texts_without_id_of_equal_short_hash_stay_apart(spark):
    """Two texts whose 32-bit hashes are equal; a third row repeats the first."""
    made = spark.range(1 << 18).select(F.expr("concat('w', id, ' ', repeat('x ', 1))").alias("t"))
    made = made.select(F.expr("concat_ws(' ', transform(sequence(1, 40), i -> concat(trim(t), i)))").alias("t"))
    clash = (
        made.groupBy(F.hash("t", F.lit(True)).alias("h"))
        .agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .first()
    )
    rows = [(None, clash.a), (None, clash.b), (5, clash.a)]
    got = substrings.remove_repeats(documents(spark, rows)).collect()
    left = sorted((r.doc_id or 0, r.n_removed) for r in got)
    n = len(clash.a.split())
    assert left == [(0, 0), (0, n), (5, n)]


def test_shards_are_even_and_gapless(spark, odd):
    got = sharding.shard_by_bytes(documents(spark, odd), shards=4).collect()
    assert len(got) == len(odd)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 8) for i, t in odd
    )
    by_shard = collections.defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    for rows in by_shard.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    mean, most = sum(r.size for r in got) / 4, max(r.size for r in got)
    assert all(sum(r.size for r in rows) <= mean + most for rows in by_shard.values())


def test_shards_of_documents(spark, sf_dir):
    got = sharding.op1_sampled_splitters(spark, sf_dir).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == sharding.SHARDS
    assert size.max() - size.min() <= 2 * got["size"].max()


def brute_repeats(rows, length=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = collections.Counter(
        tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1)
    )
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substrings_match_brute_force(spark, odd):
    got = substrings.digest(substrings.remove_repeats(documents(spark, odd))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(odd)


def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, odd):
    got = simhash.fingerprints(documents(spark, odd)).collect()
    wanted = [(i, brute_fingerprint(t)) for i, t in odd]
    assert sorted((r.id or -1, r.fp % (1 << 64)) for r in got) == sorted(
        (i or -1, f) for i, f in wanted
    )


@pytest.mark.parametrize("limit", [simhash.SHARD_LIMIT, 5])
def test_near_links_connect_all_within_radius(spark, limit):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 30, np.uint64)
    made = [int(b) for b in base]
    for b in base[:10]:
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            made.append(int(b) ^ sum(1 << int(f) for f in flips))
    made = sorted(set(made))
    signed = [m - (1 << 64) if m >> 63 else m for m in made]
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp bigint, node bigint")
    links = [(r.a, r.b) for r in simhash.near_links(nodes, 3, limit).collect()]

    def labels(pairs):
        label = list(range(len(made)))
        for _ in range(len(made)):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    wanted = [
        (i, j)
        for i in range(len(made))
        for j in range(i)
        if (made[i] ^ made[j]).bit_count() <= 3
    ]
    assert labels(links) == labels(wanted)


def test_statistics(spark, odd):
    rows = outliers.with_statistics(documents(spark, odd)).select("text", "__s").collect()
    for row in rows:
        text = row.text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        count = collections.Counter(grams)
        again = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
        assert tuple(row["__s"]) == (
            len(words),
            sum(map(len, words)),
            sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)),
            len(again),
            len(lines),
            text.count("|"),
        )


def test_outliers_keep_the_common_and_drop_the_odd(spark):
    random.seed(6)
    plain = [
        (i, " ".join(f"w{random.randrange(10**6)}" for _ in range(80))) for i in range(300)
    ]
    odd_one = (999, " ".join(f"{i}#*$%&|<>#*$" for i in range(80)))
    got = outliers.robust_outliers(documents(spark, [*plain, odd_one])).collect()
    kept = {r.row.doc_id: r.kept for r in got}
    assert not kept[999] and sum(kept.values()) >= 299


def test_outliers_cases(spark, odd):
    got = outliers.robust_outliers(documents(spark, odd)).collect()
    assert len(got) == len(odd)
    assert all(not r.kept for r in got if r["__s"].n_words < outliers.LEAST_WORDS)


def _plain_estimate(x):
    """Mean, scaled covariance and rows of the minimum-covariance-determinant estimate."""
    rank = lambda v, p: np.sort(v)[max(0, int(np.ceil(p * len(v))) - 1)]
    floors = np.diag(np.square(outliers.FLOORS))

    def far(m, c):
        z = np.linalg.solve(np.linalg.cholesky(c), (x - m).T)
        return (z * z).sum(axis=0)

    def step(m, c):
        d = far(m, c)
        near = x[d <= rank(d, outliers.SUBSET)]
        return near.mean(axis=0), np.cov(near.T, bias=True) + floors

    quarters = [[rank(v, p) for v in x.T] for p in (0.25, 0.5, 0.75)]
    spread = (np.array(quarters[2]) - quarters[0]) / 1.349
    starts = [
        (np.array(quarters[1]), np.diag(spread**2) + floors),
        (x.mean(axis=0), np.cov(x.T, bias=True) + floors),
    ]
    for _ in range(outliers.FIRST_STEPS):
        starts = [step(*s) for s in starts]
    log_det = lambda s: np.linalg.slogdet(s[1])[1] / 2
    best = min(starts, key=log_det)
    while log_det(after := step(*best)) < log_det(best) - outliers.SETTLED:
        best = after
    scale = max(1.0, rank(far(*best), 0.5) / outliers.MEDIAN)
    return best[0], scale * best[1], len(x)


def _plain_drawn(own, coarse):
    (m, c, n), (m0, c0) = own, coarse
    w = n / (n + outliers.STRENGTH)
    apart = np.outer(m - m0, m - m0)
    return w * m + (1 - w) * m0, w * c + (1 - w) * c0 + w * (1 - w) * apart


def test_outlier_distances_against_plain_estimates(spark):
    """Groups of 400, 60, 9 and 1 rows, one of copies, null languages and sources."""
    rng = random.Random(8)
    sizes = {("en", "a"): 400, ("en", "b"): 60, (None, "a"): 9, ("de", None): 1, ("de", "c"): 40}
    rows = []
    for (lang, source), n in sizes.items():
        for i in range(n):
            word = lambda: "w" * rng.randrange(1, 12)
            text = " ".join(word() + rng.choice(["", "", "|", "#"]) + str(rng.random()) for _ in range(60))
            if i % 7 == 0:
                text += "\nsame line here" * rng.randrange(1, 5)
            rows.append((len(rows), "copy " + "a b c d e f " * 4 + text if (lang, i) == ("en", 3) else text, lang, source))
    rows += [(1000 + i, rows[400][1], "en", "b") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = outliers.robust_outliers(docs).withColumns(
        {f"v{i}": x for i, x in enumerate(outliers.vector(F.col("__s")))}
    )
    got = [r for r in got.collect() if not r.base_failed]
    assert len(got) > 500
    x = np.array([[r[f"v{i}"] for i in range(outliers.DIMENSIONS)] for r in got])
    lang = np.array([r.lang for r in got])
    source = np.array([r.source for r in got])
    prior = np.eye(outliers.DIMENSIONS) * outliers.PRIOR**2
    everything = _plain_estimate(x)
    whole = _plain_drawn(everything, (everything[0], prior))
    for one in set(lang):
        spoken = _plain_drawn(_plain_estimate(x[lang == one]), whole)
        for other in set(source[lang == one]):
            here = (lang == one) & (source == other)
            m, c = _plain_drawn(_plain_estimate(x[here]), spoken)
            z = np.linalg.solve(np.linalg.cholesky(c), (x[here] - m).T)
            found = [r.distance for r, h in zip(got, here, strict=True) if h]
            assert np.allclose(found, (z * z).sum(axis=0), rtol=1e-6)


def test_toxicity_held_out(spark):
    random.seed(7)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{random.randrange(300)}" for _ in range(40)]
        for at in (10, 20, 30, 39):
            words[at] += "."
        bad = i % 4 == 0
        if bad:
            words[15] = random.choice(["scum", "moron"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs = documents(spark, [*rows, (None, None), (700, "")])
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, table)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = sum((got[i].score >= 0.5) != (i % 4 == 0) for i in range(600))
    assert wrong <= 6
    assert got[700].score == 0 and got[None].score == 0
    # The second sentence of a toxic document is the one to blame.
    assert {s.sentence for s in got[0].offending} == {1}
    column = docs.select("doc_id", toxicity.score_column(model).alias("s")).collect()
    assert all(abs(r.s - got[r.doc_id].score) < 1e-12 for r in column)


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, odd)
    assert {round(r.score, 6) for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0}


def test_neighbours_recall(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    vectors[100:300] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(4000, None), (4020, [0.0] * 16), (4040, [float("nan")] * 16), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = collections.defaultdict(list)
    for r in multiindex.nearest(table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = vectors.astype(np.float64)
    found = 0
    for q in range(0, 3000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:20]
        found += len(set(best) & {v for v, _ in got[q]})
        assert len(got[q]) == 20
        assert all(abs(score[v] - s) < 1e-9 for v, s in got[q])
    assert found / (150 * 20) >= 0.9
    assert set(got) == set(range(0, 3000, 20))


def test_recall_on_vectors_without_structure(spark):
    """20,000 normal vectors of 64 components: the hard case for any index."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(8)
    got = collections.defaultdict(list)
    for r in multiindex.nearest(table, query_step=200).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    x, found = x.astype(np.float64), 0
    for q in range(0, 20_000, 200):
        score = x @ x[q]
        score[q] = -np.inf
        found += len(set(np.argsort(-score)[:20]) & {v for _, v, _ in got[q]})
    assert found / (100 * 20) >= 0.9


def test_products_that_are_equal_go_to_the_smaller_id(spark, monkeypatch):
    """Different vectors of one product; other lengths, repeated ids and columns beside."""
    monkeypatch.setattr(multiindex, "BLOCK_ENTRIES", 3)
    monkeypatch.setattr(multiindex, "QUERY_GROUP", 1)
    monkeypatch.setattr(multiindex, "entries_needed", lambda *_: 10**9)  # walk to the end
    rng = np.random.default_rng(5)
    base = rng.permutation([0.1, 0.3, 0.7, 1.1, 1.3, 1.7, 1.9, 2.3])
    rows = [(0, [1.0] * 8)] + [(i, rng.permutation(base).tolist()) for i in range(1, 60)]
    rows += [(7, [9.0] * 8), (20, [2.0] * 3), (21, [1.0] * 3), (22, [5.0]), (40, [4.0])]
    full = [(i, v, "x", 1.0) for i, v in rows]
    schema = "vec_id bigint, embedding array<float>, query_id string, score double"
    got = collections.defaultdict(list)
    found = multiindex.nearest(spark.createDataFrame(full, schema), k=10)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    # Every permutation has the same sum, which is its product with the ones.
    assert [v for v, _ in got[0]] == [7, *range(1, 10)]
    assert len({s for v, s in got[0] if v != 7}) == 1
    assert (21, 6.0) in got[20] and (22, 20.0) in got[40]


def test_walk_is_in_order():
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=6), rng.normal(size=7)
    cells = list(multiindex.walk(a, b))
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sorted(cells) == list(range(42)) and sums == sorted(sums, reverse=True)


def test_packing_keeps_every_token(spark, odd):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rows = [(i if i is not None else -n - 1, t) for n, (i, t) in enumerate(odd)]
    rows = list(dict(rows).items())
    got = packing.pack(documents(spark, rows), path).toPandas()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in got[got.doc_id == doc_id].sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids)
            assert zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    used = got.groupby("sequence_id")["length"].sum()
    assert used.max() <= packing.WINDOW
    assert (packing.WINDOW - used).sum() <= packing.WINDOW + packing.SLIVER * len(used)


def test_packing_of_many_mostly_empty_partitions(spark):
    # Two rows, in the first and the last of 650 partitions.
    rows = [(i, "word " * 1500) for i in range(2)]
    schema = documents(spark, rows).schema
    full = [(i, t, None, None, 0, 0) for i, t in rows]
    parts = [full[:1], *[[]] * 648, full[1:]]
    spread = spark.createDataFrame(
        spark.sparkContext.parallelize(parts, 650).flatMap(lambda x: x), schema
    )
    got = packing.pack(spread, packing.default_tokenizer()).toPandas()
    used = got.groupby("sequence_id")["length"].sum()
    assert used.sum() == got.groupby("doc_id")["doc_tokens"].first().sum()
    assert used.max() <= packing.WINDOW and (used < packing.WINDOW).sum() <= 1


def test_encoder_knows_added_tokens():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [end, f"a {end} b", f"one{end}{end}two  {end} ", "no such <|endof text|>", None, f"é{end}\n x"]
    wanted = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = [ids.tolist() for ids in packing.Encoder(path).encode(pa.array(texts))]
    assert got == wanted and sum(ids.count(tokenizer.token_to_id(end)) for ids in got) == 6


def test_pieces_match_the_model(spark, odd):
    import sentencepiece

    path = pieces.default_model()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = documents(spark, [(n, t) for n, (_, t) in enumerate(odd)])
    encoded = pieces.encode(docs, path)
    for r in encoded.collect():
        assert r.ids == model.encode(odd[r.doc_id][1] or "") and r.round_trip
    back = {r.doc_id: r.text for r in pieces.decode(encoded, path).collect()}
    assert back == {n: t or "" for n, (_, t) in enumerate(odd)}


def test_viterbi_takes_the_best_sum(spark):
    words = spark.createDataFrame([("abc",), ("zz",)], "word string")
    table = spark.createDataFrame(
        [("a", -1.0), ("b", -1.0), ("ab", -1.5), ("c", -1.0), ("bc", -0.2)],
        "piece string, score double",
    )
    got = {r.word: r.pieces for r in pieces.viterbi_words(words, table, 3).collect()}
    assert got["abc"] == ["a", "bc"]


def test_url_rules(spark):
    urls = [
        (1, None), (2, ""), (3, "abc"), (4, "http://A.Example.ORG/es/x?y#z"), (5, "http://org"),
        (None, "http://a.com/fr/"), (7, "http://a.com/de/"), (7, "http://a.com/de/"),
    ]
    urls += [
        (100 + i, f"http://{'spam' if i % 5 == 0 else 'fine'}.net/p/{i}") for i in range(400)
    ]
    labels = [(100 + i, int(i % 5 != 0), 0) for i in range(200)]
    got = urlrules.judge(
        spark.createDataFrame(urls, "page_id bigint, url string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    ).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == len(urls)
    assert (by_id[4].host, by_id[4].path) == ("a.example.org", "/es/x")
    assert (by_id[4].rule, by_id[4].verdict) == ("example.org/es/", "block")
    assert by_id[7].verdict == "block" and by_id[None].verdict == "allow"
    assert by_id[1].host == "" and by_id[3].verdict == "allow"
    assert all((by_id[100 + i].verdict == "block") == (i % 5 == 0) for i in range(400))


def mined(spark, urls, bad):
    """Rules (tokens, confidence) of pages numbered in order."""
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    labels = spark.createDataFrame(
        [(i, 0 if b else 1, 0) for i, b in enumerate(bad)], "doc_id bigint, quality int, toxic int"
    )
    tokens = urlrules.tokens(urlrules.parsed(pages))
    return pages, labels, tokens, urlrules.mined_rules(tokens, labels)


def test_url_rules_against_brute_force(spark):
    """All rules of a small table, by trying every set of its tokens."""
    import itertools

    random.seed(21)
    urls, bad = [], []
    for _ in range(500):
        host = random.choice(["a.com", "b.a.com", "c.org"])
        names = [n for n in "pqrs" if random.random() < 0.5]
        urls.append(f"http://{host}/" + random.choice(["x", "y"]) + "?" + "&".join(f"{n}=1" for n in names))
        bad.append(set("pqr") <= set(names) or (host == "c.org" and random.random() < 0.5))
    _, _, tokens, rules = mined(spark, urls, bad)
    sets = [frozenset(r.tokens) for r in tokens.orderBy("page_id").collect()]
    least = max(urlrules.LEAST_PAGES, int(np.ceil(urlrules.LEAST_SUPPORT * len(urls))))
    sure = {}
    for size in range(1, 8):
        for some in itertools.combinations(sorted(frozenset().union(*sets)), size):
            hit = [b for s, b in zip(sets, bad, strict=True) if s.issuperset(some)]
            if sum(hit) >= least and sum(hit) >= 0.8 * len(hit):
                sure[frozenset(some)] = sum(hit) / len(hit)
    kept = {s: c for s, c in sure.items() if not any(t < s and sure[t] >= c for t in sure)}
    got = {frozenset(r.tokens): r.confidence for r in rules.collect()}
    # Of sets on the very same pages any one may stand for the others.
    pages_of = lambda s: frozenset(i for i, x in enumerate(sets) if x >= s)
    assert {pages_of(s): c for s, c in got.items()} == {pages_of(s): c for s, c in kept.items()}


def test_url_rules_of_tokens_that_others_imply(spark):
    """p and q are bad only together; each of thirty more names comes with p alone, so it
    implies p, and has too few bad pages for a rule.  Of names that come together any fits."""
    urls, bad = [], []
    for i in range(600):
        names = [f"only{i % 30}", "p"] if i % 2 else []
        names += ["q"] if i % 3 == 0 else []
        urls.append(f"http://h.net/{'one' if i < 300 else 'two'}?" + "&".join(f"{n}=1" for n in names))
        bad.append("p" in names and "q" in names)
    urls += ["http://s.net/?u=1&v=1"] * 30
    bad += [True] * 30
    pages, labels, _, rules = mined(spark, urls, bad)
    assert ("query=p", "query=q") in {tuple(sorted(r.tokens)) for r in rules.collect()}
    more = [(1000, "http://new.net/?p=2&q=2"), (1001, "http://new.net/?q=2"), (1002, "http://new.net/?v=2")]
    more = spark.createDataFrame(more, "page_id bigint, url string")
    verdict = {r.page_id: r.verdict for r in urlrules.judge(pages.union(more), labels, rules=()).collect()}
    assert all((verdict[i] == "block") == b for i, b in enumerate(bad))
    assert [verdict[i] for i in (1000, 1001, 1002)] == ["block", "allow", "block"]


def test_url_rules_of_four_tokens_and_of_deep_paths(spark):
    """Four query names that are bad only together; paths of forty parts; a host of many dots."""
    random.seed(3)
    urls, bad = [], []
    for i in range(400):
        names = list("abcd") if i < 40 else random.sample("abcd", 3)
        urls.append("http://h.net/?" + "&".join(f"{n}={i}" for n in names))
        bad.append(i < 40)
    deep = "/".join(f"part-{j}x" for j in range(40))
    urls += [f"http://deep.org/{deep}/{i}" for i in range(60)] + ["http://" + "d." * 3000 + "net/"] * 30
    bad += [i < 30 for i in range(60)] + [True] * 30
    pages, labels, _, _ = mined(spark, urls, bad)
    verdict = {r.page_id: r.verdict for r in urlrules.judge(pages, labels, rules=()).collect()}
    assert all((verdict[i] == "block") == (i < 40) for i in range(400))
    assert all(verdict[i] == "allow" for i in range(400, 460))
    assert all(verdict[i] == "block" for i in range(460, 490))


def test_sites_shrink_toward_the_prior(spark):
    rows = [("=big", "=a", int(i % 10 == 0)) for i in range(400)]
    rows += [("=fine", "=a", 1) for _ in range(400)] + [("=tiny", "=a", 0)]
    table = spark.createDataFrame(rows, "host string, path string, good int")
    by_host, by_path, everywhere = sitequality.site_posteriors(table)
    share = {r.host: r.host_share for r in by_host.collect()}
    assert share["=big"] < share["=tiny"] < everywhere < share["=fine"]


def _plain_statistics(text):
    n = len(text)
    share = lambda marks: sum(c in marks for c in text) / max(n, 1)
    words, lines = text.split(" "), text.split("\n")
    return [
        np.log1p(n), share("#*$%&<>") ** 0.5, share("|") ** 0.5, share("!") ** 0.5,
        share(sitequality.LETTERS), share(sitequality.DIGITS), share(" "),
        len(set(words)) / len(words), len(set(lines)) / len(lines),
    ]


def _plain_strength(counts):
    """counts: (n, good, prior) of each site."""
    n = np.array(counts, float)
    chance = n[:, 2] * (1 - n[:, 2])
    total, squares = n[:, 0].sum(), (n[:, 0] ** 2).sum()
    if total**2 <= squares:
        return sitequality.MOST_STRENGTH
    spread = (n[:, 0] * (n[:, 1] / n[:, 0] - n[:, 2]) ** 2).sum()
    between = (spread - chance.sum()) / (total - squares / total)
    if between <= 0:
        return sitequality.MOST_STRENGTH
    return min(sitequality.MOST_STRENGTH, max(sitequality.LEAST_STRENGTH, chance.mean() / between - 1))


def test_site_scores_against_plain_model(spark):
    """Evidence by Newton steps, posteriors by the formulas; sites by page, else by source."""
    rng = random.Random(31)
    rows, labels, pages = [], [], []
    sites = [(f"h{i % 7}.net", f"p{i % 3}") for i in range(21)]
    taste = {site: rng.uniform(0.1, 0.9) for site in sites}
    site_of = {}
    for i in range(1200):
        host, path = rng.choice(sites)
        good = rng.random() < taste[host, path]
        text = "".join(rng.choice("ab AB9!\n |#" if not good or rng.random() < 0.3 else "abcd ") for _ in range(rng.randrange(0, 90)))
        if i % 3:
            pages.append((i, f"http://{host}/{path}/{i}?x"))
            site_of[i] = (host, path)
        else:
            site_of[i] = ("=" + host, "" if path == "p0" else "=" + path)
        rows.append((i, text, None if path == "p0" else path, host))
        if i % 4:
            labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    tables = (
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        spark.createDataFrame(pages, "page_id bigint, url string"),
    )
    got = {r.doc_id: r for r in sitequality.score_sites(docs, *tables).collect()}
    assert len(got) == len(rows)

    learn = [(i, g) for i, g, _ in labels if zlib.crc32(str(i).encode()) % 5]
    x = np.array([_plain_statistics(t) for _, t, _, _ in rows])
    at, y = np.array([i for i, _ in learn]), np.array([g for _, g in learn], float)
    ones = np.column_stack([np.ones(len(at)), x[at]])
    ridge = np.diag([0.0, *(0.001 * x[at].var(axis=0, ddof=1))])
    beta = np.zeros(ones.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-ones @ beta))
        slope = ones.T @ (p - y) / len(y) + ridge @ beta
        bend = (ones * (p * (1 - p))[:, None]).T @ ones / len(y) + ridge
        beta -= np.linalg.lstsq(bend, slope, rcond=None)[0]
    evidence = np.column_stack([np.ones(len(x)), x]) @ beta - np.log(y.mean() / (1 - y.mean()))

    by_path = collections.defaultdict(list)
    by_host = collections.defaultdict(list)
    for i, g in learn:
        by_path[site_of[i]].append(g)
        by_host[site_of[i][0]].append(g)
    everywhere = (y.sum() + 1) / (len(y) + 2)
    k = _plain_strength([(len(v), sum(v), everywhere) for v in by_host.values()])
    host_share = {h: (sum(v) + k * everywhere) / (len(v) + k) for h, v in by_host.items()}
    k = _plain_strength([(len(v), sum(v), host_share[s[0]]) for s, v in by_path.items()])
    for i, r in got.items():
        host, path = site_of[i]
        assert (r.host, r.path) == (host, path)
        labelled = by_path.get((host, path), [])
        prior = host_share.get(host, everywhere)
        share = (sum(labelled) + k * prior) / (len(labelled) + k) if labelled else prior
        assert abs(r.site_share - share) < 1e-9
        assert abs(r.evidence - evidence[i]) < 0.02
        wanted = 1 / (1 + np.exp(-(r.evidence + np.log(share / (1 - share)))))
        assert abs(r.score - wanted) < 1e-9 and r.kept == (r.score >= 0.5)


def test_toxicity_of_a_very_long_text(spark):
    """The one toxic sentence at the very end of a text of two million characters counts."""
    random.seed(17)
    plain = lambda n: " ".join(f"w{random.randrange(200)}" for _ in range(n)) + "."
    rows = [(i, plain(20) + (" You scum moron." if i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    long_text = " ".join(plain(20) for _ in range(20_000))
    rows += [(1000, long_text + " You scum moron."), (None, plain(5))]
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1000].score >= 0.5 and len(long_text) > 1_500_000
    assert max(s.sentence for s in got[1000].offending) == 20_000


def test_pieces_of_very_long_words(spark):
    """Words around and over the length from which merges come from a heap."""
    import sentencepiece

    path = pieces.default_model()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    random.seed(23)
    sizes = [pieces.LONG - 1, pieces.LONG, pieces.LONG + 1, 500, 3_000, 20_000]
    texts = ["".join(random.choice("abcdeinrst") for _ in range(n)) for n in sizes]
    texts += ["a" * 5_000, "é日🙂" * 400, " " * 700 + "x", "ab " * 5 + "the" * 900 + " end"]
    docs = documents(spark, list(enumerate(texts)))
    for r in pieces.encode(docs, path).collect():
        assert r.ids == model.encode(texts[r.doc_id]) and r.round_trip


def test_longest_given_rule_wins_beside_clashing_columns(spark):
    pages = spark.createDataFrame(
        [(1, "http://x.example.org/es/", "r", 1), (2, "http://example.org/en/1", "s", 2), (3, None, "t", 3)],
        "page_id bigint, url string, host string, verdict int",
    )
    labels = spark.createDataFrame(
        [(1, 1, 0, "q")], "doc_id bigint, quality int, toxic int, url string"
    )
    got = {r.page_id: (r.rule, r.verdict) for r in urlrules.judge(pages, labels).collect()}
    assert got == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: (None, "allow")}


def test_empty_tables(spark):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id bigint, url string")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    results = [
        sharding.shard_by_bytes(docs),
        toxicity.score(docs, toxicity.fit(docs, labels)),
        outliers.robust_outliers(docs),
        multiindex.nearest(vectors),
        packing.pack(docs, packing.default_tokenizer()),
        substrings.remove_repeats(docs),
        simhash.near_duplicate_groups(docs),
        sitequality.score_sites(docs, labels, pages),
        urlrules.judge(pages, labels),
        pieces.encode(docs, pieces.default_model()),
    ]
    assert [r.count() for r in results] == [0] * 10


def test_held_out_rule(spark):
    got = spark.range(50).select("id", common.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
