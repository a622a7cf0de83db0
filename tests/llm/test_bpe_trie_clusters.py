"""Byte-level BPE against tiktoken, the conversation trie and the clusters against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from refinery.llm import bpe, nsbounds, queries, trie

LONG = "word, " * 4000
TEXTS = [None, "", " ", "a", "  two  blanks\t\n\n x", "don't we'll 'tis x's'", "é ñ 漢字かな 🙂 à", "12 345,67", "x" * 700, "ab" * 400 + " tail",
         " " * 600 + "end", "Ünïcode line", "nul \0 byte", "\U0001df00 newer letters \U00010d40", LONG, "zqxj" * 20, "zqxj" * 20]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(), special_tokens={})


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# ---------------------------------------------------------------- byte-level BPE

@pytest.mark.parametrize("frequent", [0, 5, 1 << 18])
def test_ids_and_bytes_equal_tiktoken(spark, reference, frequent):
    """Whatever is looked up as frequent, folded in place or merged by heap."""
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string").repartition(3)
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, frequent=frequent).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = reference.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(t or "")), t


def test_the_fold_alone_equals_tiktoken_on_random_words(spark, reference):
    rnd = random.Random(5)
    words = sorted({" " * rnd.randint(0, 1) + "".join(rnd.choice("etaoinshrdluézß") for _ in range(rnd.randint(1, 60))) for _ in range(150)})
    tables = bpe.Tables.of(spark, bpe.read_ranks())
    rows = tables.add(spark.createDataFrame([(w,) for w in words], "word string"), "ids", lambda t, row: bpe.merged(t, row["word"]))
    assert {r["word"]: r["ids"] for r in rows.collect()} == {w: reference.encode_ordinary(w) for w in words}


def test_merger_equals_tiktoken_on_random_bytes(reference):
    rnd, merge = random.Random(6), bpe.Merger(bpe.read_ranks(), public_tokenizers.PATTERN)
    for _ in range(200):
        text = "".join(rnd.choice(["a", "b", "ab", "the", " ", "  ", "=", "\n", "é", "7"]) for _ in range(rnd.randint(0, 400)))
        assert merge.text(text) == reference.encode_ordinary(text)


def test_literal_tables_are_no_column(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    coded, tables = bpe.encode(docs, ("doc_id",), frequent=0)
    plan = bpe.decode(coded, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "__tables" not in plan and "Join" not in plan


def test_frequent_words_are_no_literal_of_the_plan(spark):
    """They are looked up by Arrow batches: no expression, task or row of the JVM carries them."""
    docs = spark.createDataFrame([(1, "one two one"), (2, None)], "doc_id long, text string")
    coded, tables = bpe.encode(docs, ("doc_id",))
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert tables.row.columns == ["pairs", "first", "singles", "pieces"]
    assert "ArrowEvalPython" in plan and "transform(" not in plan and "map<" not in plan
    assert sorted((r["doc_id"], len(r["ids"])) for r in coded.collect()) == [(1, 3), (2, 0)]


def test_scans_and_heap_leave_the_same_pieces():
    rnd, merge = random.Random(7), bpe.Merger(bpe.read_ranks(), public_tokenizers.PATTERN)
    for _ in range(300):
        data = "".join(rnd.choice("etaoin shrdluéß=7") for _ in range(rnd.randint(0, 60))).encode()
        assert merge.scanned(data) == merge.heaped(data) if data else merge.pieces(data) == []


def test_look_up_keeps_no_more_than_its_memo_and_equals_tiktoken(reference):
    rnd, merge = random.Random(8), bpe.Merger(bpe.read_ranks(), public_tokenizers.PATTERN)
    texts = TEXTS[1:] + [" ".join("".join(rnd.choice("abcé'-.\n") for _ in range(rnd.randint(1, 9))) for _ in range(300)) for _ in range(40)]
    ids = lambda w: np.array(reference.encode_ordinary(w), "<u4").tobytes()
    lookup = bpe.Lookup(merge, {w: ids(w) for w in (" a", "a", " b", "  ")}, memo=100, unit=500)
    assert [[*np.frombuffer(x, "<u4")] for x in lookup.encode_all(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert len(lookup.memo) + len(lookup.older) <= 100 and len(lookup.marks) <= 100


def test_words_that_the_pattern_splits_are_not_looked_up():
    merge, found = bpe.Merger(bpe.read_ranks(), public_tokenizers.PATTERN), pa.table({"word": ["!\u00e9", "\u00e9a", "ab"], "ids": [[1], [2, 3], [4]]})
    assert {w: [*np.frombuffer(x, "<u4")] for w, x in bpe.as_words(found, merge.split).items()} == {"\u00e9a": [2, 3], "ab": [4]}


def test_bpe_of_an_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# ---------------------------------------------------------------- conversation trie

def plain_trie(rows):
    """The contract, conversation by conversation."""
    whole = {}
    for c, turn, role, text in rows:
        if c is not None:
            whole.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    def digest(t):
        return sha(f"{len(t[2])}:{t[2]}{t[3]}")
    turns = {c: [(r, x) for _, _, r, x in sorted(ts, key=lambda t: (t[0], t[1], digest(t)))] for c, ts in whole.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = turns.get(base, [])[:h] + own[h:]
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    words = lambda node: len([w for w in node[-1][1].translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]) if node else 0
    out = []
    for node, cs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        ends = sorted(c for c in cs if len(built[c]) == len(node))
        children = sum(len(m) == len(node) + 1 for m in below)
        leaves = sum(not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in below) for m in below)
        saved = sum((len(members[m]) - 1) * words(m) for m in below)
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children, leaves, saved,
                    sha(",".join(map(str, ends)))))
    return sorted(out, key=str)


def made_conversations():
    rnd = random.Random(9)
    rows = []
    for c in [*range(0, 45), 60, 61, 63, 1001, -3]:
        for turn in range(rnd.choice([1, 2, 3, 3, 5, 9, 23])):
            if rnd.random() < 0.95:
                rows.append((c, turn, rnd.choice(["user", "assistant", None]) if turn > 1 else "user", rnd.choice(["yes", "no  way\nat all", "", None, "a b c"])))
    same = [(c, t, "user", f"turn {t}") for c in range(200, 240) for t in range(12)]          # a group of copies
    odd = [(70, None, "user", "first"), (70, 1, "x", "y"), (70, 1, "x", "y"), (70, 1, "a", "z"), (None, 1, "user", "nobody's")]
    return rows + same + odd


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_equals_the_plain_version(spark, width):
    """Conversations end within, at and beyond a block of columns, whatever its width."""
    rows = made_conversations()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int").repartition(4)
    got = trie.conversation_trie(table, width).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(rows)


def test_trie_of_an_empty_table_and_of_bare_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    bare = [(c, 0, "user", "only") for c in (21, 22, 23, 24, 25) if zlib.crc32(str(c).encode()) % 4 > 0]
    got = trie.conversation_trie(spark.createDataFrame(bare, schema)).collect()
    assert [(r["depth"], r["n_convs"], r["n_leaves"], r["saved_tokens"]) for r in got] == [(0, len(bare), 1, 0)]


def test_running_sums_cross_chunks(spark):
    """One key holds most rows; the sums equal a plain pass."""
    rows = [(1 if i % 10 else i, i, i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["k"], r["o"]): r["s"] for r in trie.running(df, ["k"], ["o"], {"s": F.col("v")}).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sums = {}
    for k, o, v in rows:
        assert got[k, o] == sums.get(k, 0)
        sums[k] = sums.get(k, 0) + v


# ---------------------------------------------------------------- centroid clustering

def plain_clusters(rows, k=16, rounds=3, scale=64, width=64):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: "null" if i is None else str(i)
    centroids = [q for _, q in sorted(kept, key=lambda r: (sha(f"1:{name(r[0])}"), r[1]))[:k]]
    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        of = [nearest(q)[1] for _, q in kept]
        for j in set(of):
            mine = [q for (_, q), o in zip(kept, of) if o == j]
            centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *nearest(q)) for i, q in kept]
    sums = {}
    for _, d, j in last:
        sums[j] = sums.get(j, 0) + d
    return sorted(((i, j, d, sums[j], sum(sums.values()), sha(",".join(map(str, centroids[j])))) for i, d, j in last), key=str)


def vectors(n, seed, width=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(20, width))
    return [(i, (middle[i % 20] * 0.3 + rng.normal(size=width) * 0.2).tolist()) for i in range(n)]


def test_clusters_equal_the_plain_version(spark):
    rows = vectors(300, 4)
    same = [(1000 + i, rows[0][1]) for i in range(150)]                                  # a group of copies
    odd = [(2001, None), (2002, [0.5] * 63), (2003, [0.5] * 63 + [None]), (2004, [float("nan")] * 64), (2005, [float("inf")] + [0.0] * 63),
           (None, [0.25] * 64), (7, rows[7][1]), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, "x", 3) for i, v in rows + same + odd], "vec_id long, embedding array<double>, cluster string, q int").repartition(5)
    got = nsbounds.clustered(table).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows + same + odd)


@pytest.mark.parametrize("n", [0, 1, 5, 16])
def test_few_vectors(spark, n):
    rows = vectors(n, 8)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nsbounds.clustered(table).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    as_float = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    assert sorted(map(tuple, got), key=str) == plain_clusters(as_float)


def test_huge_components_are_held_at_the_limit(spark):
    rows = [(1, [1e30] * 64), (2, [-1e30] * 64), (3, [0.0] * 64)]
    got = nsbounds.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1).collect()
    assert len(got) == 3 and all(r["distance"] >= 0 for r in got)


def test_bounds_rescan_exactly_what_they_cannot_rule_out():
    """Rounds with stored bounds equal full evaluations, with fewer distances; a centroid that goes away and
    comes back is judged by its total displacement, so its old bound holds again."""
    rng = np.random.default_rng(2)
    q = rng.integers(-60, 60, (2000, 64))
    a = rng.integers(-60, 60, (16, 64))
    history = [a, a + rng.integers(-3, 4, a.shape), a + rng.integers(-3, 4, a.shape), a.copy()]
    state, taken = None, []
    for t in range(len(history)):
        cluster, near, seen, n = nsbounds.assign(q, np.array(history[:t + 1]), state)
        full = ((q[:, None] - history[t]) ** 2).sum(axis=2)
        assert (cluster == full.argmin(axis=1)).all()
        assert (near[np.arange(len(q)), cluster] == full.min(axis=1)).all()
        state, taken = (cluster, near, seen), [*taken, n]
    assert taken[0] == q.shape[0] * 16 and max(taken[1:]) < taken[0] / 2
    assert taken[3] < taken[1]                                   # back at the start: the sum of drifts would rescan more


def test_queries_read_whole_tables(spark):
    for name, table in (("op12_conversation_trie", "conversations"), ("op13_centroid_clusters", "embeddings")):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, table
