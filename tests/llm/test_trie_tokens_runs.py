"""The prefix trie, the token transducer and periodic runs against plain versions."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from reviewloom.llm import periodic, prefixtrie, queries, transducer

TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, part int"


def brute_trie(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = {}
    for node, ids in members.items():
        under = [m for m in members if m[: len(node)] == node]
        leaves = [m for m in under if not any(len(x) == len(m) + 1 and x[:-1] == m for x in members)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in under if m)
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        children = sum(len(x) == len(node) + 1 and x[:-1] == node for x in members)
        out[min(ids), len(node)] = (
            parent,
            len(ids),
            children,
            len(leaves),
            saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def as_dict(rows):
    return {
        (r.conv_id, r.depth): (
            r.parent_conv_id,
            r.n_convs,
            r.n_children,
            r.n_leaves,
            r.saved_tokens,
            r.ends_sha256,
        )
        for r in rows
    }


@pytest.fixture(scope="module")
def talks():
    """Shared beginnings, nulls, repeated rows, negative ids, absent bases, long talks."""
    random.seed(7)
    rows = []
    for c in [*range(0, 12), 100, 101, 150, 205, 206, -5, -101, 999]:
        for turn in range(random.choice([1, 2, 3, 7, 9])):
            role = random.choice(["user", "assistant", None])
            rows.append((c, turn, role, random.choice(["a", "bb", "日本", "", None])))
    rows += [(7, None, None, None), (None, 1, "user", "lost"), (300, 1, "user", "x")]
    rows += [(c, t, "user", f"long {t}") for c in (400, 401, 402) for t in range(40)]
    rows += [(500, 3, "user", "same")] * 30
    return rows


@pytest.mark.parametrize("block", [4, 4096])
def test_prefix_trie_against_brute_force(spark, talks, monkeypatch, block):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    monkeypatch.setattr(prefixtrie, "HEAVY", 20)  # some edges are heavy here
    monkeypatch.setattr(prefixtrie, "PIECE", 2)
    table = spark.createDataFrame([(*r, "x", 1) for r in talks], TURNS)
    got = prefixtrie.prefix_trie(table).collect()
    assert as_dict(got) == brute_trie(talks)
    assert len(got) == len(as_dict(got))


def test_prefix_trie_of_an_empty_table(spark):
    got = prefixtrie.prefix_trie(spark.createDataFrame([], TURNS))
    assert got.columns[0] == "conv_id" and got.count() == 0


@pytest.mark.parametrize("shape", ["path", "caterpillar", "star", "random"])
def test_contraction_gives_every_subtree_sum(spark, monkeypatch, shape):
    monkeypatch.setattr(prefixtrie, "BLOCK", 8)
    random.seed(len(shape))
    n = 120
    parent = {0: None}
    for i in range(1, n):
        parent[i] = {
            "path": i - 1,
            "caterpillar": i - 1 if i % 2 else max(0, i - 2),
            "star": 0,
            "random": random.randrange(max(0, i - 5), i),
        }[shape]
    depth = {0: 0}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    # Names that put some chains into one block and others apart.
    name = {i: (i % 3 if shape == "path" else i, depth[i]) for i in range(n)}
    amount = {i: (i % 2, i * 7) for i in range(n)}
    want = {i: list(amount[i]) for i in range(n)}
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            want[parent[i]][k] += want[i][k]
    rows = [(*name[i], *(name[parent[i]] if i else (None, None)), *amount[i]) for i in range(n)]
    tree = spark.createDataFrame(
        rows, "conv_id bigint, depth bigint, p_conv bigint, p_depth bigint, leaves bigint, saved bigint"
    )
    got = {(r.conv_id, r.depth): [r.leaves, r.saved] for r in prefixtrie.subtree_totals(tree).collect()}
    assert got == {name[i]: want[i] for i in range(n)}


DOCS = "doc_id bigint, text string, n_bytes string, id int, start string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, None) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    rows = [(None, None), (None, "a b a b a b a b"), (1, ""), (2, " \n\t "), (2, " \n\t "), (3, None)]
    rows += [(4, "word " * 5000), (5, "日本語🙂 é\x00\x85 x" * 9), (6, "<s> </s> <unk> ▁▁ a  b   c")]
    rows += [(7, "x" * 3000), (8, "ab" * 4000), (9, " leading and trailing ")]
    alphabets = ["ab ", "abc de\n", "theinron ,.", "  ▁a", "日é🙂 z", "0123456789"]
    for i in range(10, 60):
        letters = random.choice(alphabets)
        size = random.choice([5, 60, 900])
        rows.append((i, "".join(random.choice(letters) for _ in range(size))))
    return rows


def library_counts(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=transducer.default_model())
    return [len(model.encode(t)) if t else 0 for t in texts]


def test_token_counts_equal_the_library(spark, texts):
    got = transducer.count_tokens(documents(spark, texts), transducer.default_model()).collect()
    want = library_counts([t for _, t in texts])
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(
        ((i, len((t or "").encode()), n) for (i, t), n in zip(texts, want, strict=True)), key=key
    )


@pytest.mark.parametrize("size", [1, 5, 64])
def test_chunk_maps_compose_at_any_size(texts, size):
    machine = transducer.Transducer(transducer.default_model())
    short = [t for _, t in texts if t and len(t) < 1000]
    assert [machine.count(t, size) for t in short] == library_counts(short)


def test_wrong_guesses_of_entry_states_are_mended(monkeypatch, texts):
    monkeypatch.setattr(transducer, "LOOK_BACK", 0)
    machine = transducer.Transducer(transducer.default_model())
    short = [t for _, t in texts if t and len(t) < 1000]
    assert [machine.count(t, 3) for t in short] == library_counts(short)


def test_forgotten_states_are_compiled_again(monkeypatch, texts):
    monkeypatch.setattr(transducer, "MOST_STATES", 50)
    monkeypatch.setattr(transducer, "MOST_PATHS", 10)
    machine = transducer.Transducer(transducer.default_model())
    short = [t for _, t in texts if t and len(t) < 1000]
    assert [machine.count(t) for t in short] == library_counts(short)


def test_token_counts_of_documents(spark, sf_dir):
    got = transducer.op12_token_transducer(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    want = dict(zip(docs["doc_id"], library_counts(docs["text"].tolist()), strict=True))
    assert dict(zip(got["doc_id"], got["n_tokens"], strict=True)) == want
    assert (got["over_limit"] == (got["n_tokens"] > 4096)).all()


def brute_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if (length := j - i + q) >= max(6, 4 * q) and j > i:
                seg = words[i : i + length]
                if not any(seg[p:] == seg[:-p] for p in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    first = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs),
        *first,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


@pytest.fixture(scope="module")
def loops(texts):
    """Runs within runs, runs that touch, ids whose words are altered."""
    random.seed(11)
    rows = [r for r in texts if len(r[1] or "") < 4000]
    for i in range(100, 260):
        words = []
        while len(words) < random.choice([10, 80]):
            cycle = random.choices("abc", k=random.randint(1, 8))
            words += (cycle * 8)[: random.randint(1, 8 * len(cycle))]
        rows.append((i, " ".join(words)))
    nested = ("a a a a a a b " * 6).strip()
    return [*rows, (900, nested), (900, nested), (901, "x " * 5), (902, "x " * 6), (None, nested)]


@pytest.mark.parametrize("most", [1, 300, 1 << 16])
def test_runs_against_brute_force(spark, loops, monkeypatch, most):
    monkeypatch.setattr(periodic, "MOST_WORDS", most)
    got = periodic.periodic_runs(documents(spark, loops), alter=periodic.altered).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(
        ((i, *brute_row(i, t)) for i, t in loops), key=key
    )


def test_wavelet_matrix_queries():
    rng = np.random.default_rng(3)
    values = rng.permutation(57)
    matrix = periodic.WaveletMatrix(values)
    low = rng.integers(0, 56, 200)
    high = np.array([rng.integers(a + 1, 58) for a in low])
    limit = rng.integers(0, 57, 200)
    below = matrix.below(low, high, limit)
    assert below.tolist() == [
        int((values[a:b] < x).sum()) for a, b, x in zip(low, high, limit, strict=True)
    ]
    nth = np.array([rng.integers(0, b - a) for a, b in zip(low, high, strict=True)])
    assert matrix.smallest(low, high, nth).tolist() == [
        int(np.sort(values[a:b])[k]) for a, b, k in zip(low, high, nth, strict=True)
    ]


def test_runs_of_documents(spark, sf_dir):
    got = periodic.op13_periodic_runs(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    few = {r.doc_id: r.text for r in docs if len((r.text or "").split()) < 400}
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id in few:
            assert tuple(r)[1:] == brute_row(r.doc_id, few[r.doc_id])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert transducer.count_tokens(empty, transducer.default_model()).count() == 0
    assert periodic.periodic_runs(empty).count() == 0


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
