"""Exact dedup, SimHash near-dedup and paragraph sketches against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from refinery.llm import exactdedup, iblt, simhash
from refinery.llm.queries import op9_exact_dedup  # noqa: F401

WHITE = re.compile("[\x20\x09-\x0d]")


def brute_exact(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(WHITE.sub("", t or ""), []).append((-len(t or ""), d is None, d or 0, i))
    out = []
    for members in groups.values():
        best = min(members)
        keep = rows[best[3]][0]
        out += [(rows[m[3]][0], keep, len(members), m[3] == best[3]) for m in members]
    return sorted(out, key=str)


def near_same_rows():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ab \n é") for _ in range(rnd.randint(0, 6))) for _ in range(150)]
    long = "w" * 70
    return [(i, t) for i, t in enumerate(base)] + [
        (900, None), (901, ""), (902, " \t\n\x0b\x0c\r"), (None, "ab"), (None, "a b"), (905, "ab"), (905, "ab"),
        (906, long + "x"), (907, long + "y"), (908, long + " x"), (909, "z" * 100_000), (910, "z" * 99_999 + " z")]


def test_exact_dedup(spark, docs):
    rows = near_same_rows()
    got = exactdedup.exact_dedup(docs(rows, keep_id=5, kept="x", group_size=1).coalesce(1))
    plain = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()), key=str)
    want = brute_exact(rows)
    # of fully repeated rows exactly one stays, whichever the files put first
    assert plain == want
    kept = exactdedup.without_copies(docs(rows)).collect()
    assert len(kept) == sum(1 for r in want if r[3]) and kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_exact_dedup_survives_bit_collisions(spark, docs, monkeypatch):
    monkeypatch.setattr(exactdedup, "BITMAP", 32768)
    monkeypatch.setattr(exactdedup, "PREFIX", 1)
    rows = near_same_rows()
    got = exactdedup.exact_dedup(docs(rows).coalesce(1)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == brute_exact(rows)


def test_exact_dedup_empty(spark, docs):
    assert exactdedup.exact_dedup(docs([])).collect() == []


def brute_print(text, k=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "a b c a b c a b c", "É Ü x y z", "w " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_fingerprint_in_slices(monkeypatch):
    text = " ".join(map(str, range(500)))
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text) == brute_print(text)


def test_fingerprint_hash_is_the_engines(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert h % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c", 42)


def brute_components(prints, radius):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a in root:
        for b in root:
            if a < b and bin(a ^ b).count("1") <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def partition_of(labels):
    groups = {}
    for k, v in labels.items():
        groups.setdefault(v, set()).add(k)
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("tile", [4, 4096])
def test_links_find_every_component(spark, tile):
    rnd = random.Random(tile)
    seeds = [rnd.getrandbits(64) for _ in range(25)]
    prints = set(seeds) | {0, 2 ** 64 - 1, 2 ** 63}
    for s in seeds[:12]:
        p = s
        for _ in range(12):                      # chains, beyond the radius end to end
            for _ in range(rnd.randint(1, 4)):
                p ^= 1 << rnd.randrange(64)
            prints.add(p)
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.fp % 2 ** 64: r.root for r in simhash.component_of_print(frame, 3, tile).collect()}
    assert partition_of(got) == partition_of(brute_components(prints, 3))


def test_spanning_forest_is_small():
    base = np.array([1 << i for i in range(64)] + [0], np.uint64)    # all within two bits of each other
    edges = simhash._spanning(base, base, 2)
    assert len(edges) == 64


def test_tiles_beyond_the_radius_are_skipped():
    offsets = simhash._near_cells(3)
    assert len(offsets) == 65 and [0, 0, 0, 0] in offsets            # of 129 within distance 3, one of each opposite pair
    assert all(sum(map(abs, o)) <= 3 for o in offsets)


def near_rows():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        doc = [rnd.choice(words) for _ in range(300)]
        rows.append((g * 10, " ".join(doc)))
        for k in range(1, 4):
            doc = list(doc)
            doc[rnd.randrange(300)] = "changed"
            rows.append((g * 10 + k, "  ".join(doc)))
    return rows + [(None, rows[0][1]), (500, None), (501, ""), (502, "\n"), (5, rows[4][1]), (5, rows[4][1]), (None, "only this has no id")]


def test_simhash_components(spark, docs):
    rows = near_rows()
    got = simhash.simhash_components(docs(rows, fp=1, component_id="x")).collect()
    prints = [(d, brute_print(t)) for d, t in rows]
    roots = brute_components({p for _, p in prints}, 3)
    first = {}
    for d, p in prints:
        if d is not None:
            first[roots[p]] = min(d, first.get(roots[p], d))
    want = [(d, f"{p:016x}", first.get(roots[p])) for d, p in prints]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)
    assert simhash.simhash_components(docs([])).collect() == []


def test_near_dedup_keeps_one_of_each(spark, docs):
    rows = near_rows()
    roots = brute_components({brute_print(t) for _, t in rows}, 3)
    kept = simhash.near_dedup(docs(rows)).collect()
    assert len(kept) == len(set(roots.values()))
    assert len({roots[brute_print(r.text)] for r in kept}) == len(kept)
    first = {}
    for d, t in rows:
        key = roots[brute_print(t)]
        first[key] = min((d is None, d or 0), first.get(key, (d is None, d or 0)))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(first.values())


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(7, 7), (3, 2)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert {k: v for k, v in got.items() if k <= 60} == {i: 0 for i in range(61)}
    assert {v for k, v in got.items() if k >= 1000} == {1000} and len(got) == 61 + 51


def pairs_of(text):
    from collections import Counter
    return set(Counter((text or "").split("\n")).items())


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        h = len(t) // 2
        edited = t[:len(t) - h] + u[:h]
        near = [1 - len(pairs_of(t) ^ pairs_of(x)) / (len(pairs_of(t)) + len(pairs_of(x))) for x in (edited, u)]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *[round(x, 9) for x in near]))
    return sorted(out, key=str)


def sketch_rows():
    rnd = random.Random(2)
    lines = [f"line {i} é" for i in range(40)]
    rows = [(i * 3, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 30)))) for i in range(40)]
    big = "\n".join(f"p{i}" for i in range(700))
    return rows + [(1, None), (2, ""), (4, "🙂🙂🙂\n\n\n"), (7, big), (8, big + "\nmore"), (10, rows[3][1]), (11, rows[3][1])]


@pytest.mark.parametrize("chunk_rows", [4096, 5])
def test_fingerprints(spark, docs, chunk_rows, monkeypatch):
    real = iblt.with_next
    monkeypatch.setattr(iblt, "with_next", lambda d, c: real(d, c, chunk_rows))
    rows = sketch_rows()
    got = iblt.fingerprints(docs(rows, text_sha="x", elements=3)).collect()
    plain = sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=str)
    assert plain == brute_next(rows)
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(dict(rows)[r.doc_id] or "")
    assert all(len({frozenset(pairs_of(t)) for t in texts}) == 1 for texts in prints.values())
    same = [r.fingerprint for r in got if r.doc_id in (9, 10, 11)]
    assert len(set(same)) == 1


def test_fingerprints_small_tables(spark, docs):
    assert iblt.fingerprints(docs([])).collect() == []
    (one,) = iblt.fingerprints(docs([(None, "a\nb\nc")])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a\nba\n").hexdigest()


def test_peeling_recovers_the_digests_and_retries(spark):
    text = spark.createDataFrame([("a\nb\nc\na", "a\nb\nd"), ("x\n" * 300, "\n".join(map(str, range(200))))], "l string, r string")
    e = text.select(iblt.elements(F.col("l")).alias("l"), iblt.elements(F.col("r")).alias("r"))
    size = F.lit(iblt.CELLS)
    cut = e.select("l", "r", iblt.peel(iblt.minus(iblt.sketch(F.col("l"), size), iblt.sketch(F.col("r"), size)), size).alias("first"))
    rows = cut.select("*", iblt.peel_larger(F.col("first"), F.col("l"), F.col("r")).alias("all")).collect()
    assert rows[0]["first"] is not None and rows[1]["first"] is None       # 200 differences need a larger sketch
    for r in rows:
        assert {(x["key"], x["n"]) for x in r["all"]} == {(k, 1) for k in set(r.l) - set(r.r)} | {(k, -1) for k in set(r.r) - set(r.l)}
