"""Sharding laws and map versions; the pipeline against plain versions of its stages."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from refinery.llm import sharding
from refinery.llm.encode import encoder

from ..conftest import SF_SMALL
from .test_duplicates import WHITE, brute_components, brute_print
from .test_files_packing import check_packed


def shard_rows():
    rnd = random.Random(1)
    rows = [(i, "é" * rnd.choice([1, 10, 100]) + " x" * rnd.randint(0, 50)) for i in range(600)]
    rows += [(1000 + i, "the same text") for i in range(300)]
    return rows + [(None, None), (None, ""), (2000, "L" * 2000), (5, "again"), (5, "again")]


def check_places(rows, got, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_shards_hold_near_equal_bytes(spark, docs):
    rows = shard_rows()
    got = sharding.shard(docs(rows, shard=3, size="x", slot=1).repartition(6)).collect()
    check_places(rows, got, 8)
    loads = np.bincount([r.shard for r in got], [r.size for r in got], 8)
    largest_slot = max(Counter({v: sum(r.size for r in got if r.vslot == v) for v in {r.vslot for r in got}}).values())
    assert loads.max() - loads.min() <= largest_slot and loads.max() <= 1.05 * loads.mean()
    assert len({(r.vslot, r.shard) for r in got}) == len({r.vslot for r in got})


def test_map_versions_move_few_slots(spark, docs, tmp_path):
    recs = sharding.records(docs(shard_rows()))
    sizes = sharding.slot_bytes(recs)
    folder = f"file://{tmp_path}/map"
    first = sharding.store_map(sharding.edited_map(sizes, 8), folder, 1)
    same = sharding.edited_map(sizes, 8, first)
    grown = sharding.store_map(sharding.edited_map(sizes, 9, first), folder, 2)
    old, new, kept = ({r.vslot: r for r in m.collect()} for m in (sharding.read_map(spark, folder, 1), grown, same))
    assert sorted(old) == sorted(new) == list(range(sharding.SLOTS))
    total = sum(r.bytes for r in old.values())
    loads = np.bincount([r.shard for r in new.values()], [r.bytes for r in new.values()], 9)
    assert len(loads) == 9 and loads.max() <= 1.1 * total / 9
    assert sum(r.bytes for v, r in old.items() if new[v].shard != r.shard) < 0.3 * total      # all anew would move 8 / 9
    assert sum(r.bytes for v, r in old.items() if kept[v].shard != r.shard) < 0.2 * total
    shrunk = np.bincount([r.shard for r in sharding.edited_map(sizes, 5, grown).collect()])
    assert len(shrunk) == 5


def test_sharding_small_tables(spark, docs):
    assert sharding.shard(docs([])).collect() == []
    (one,) = sharding.shard(docs([(None, None)])).collect()
    assert (one.size, one.text_crc32, one.slot) == (1, 0, 0)


def test_sharding_plan_has_no_python(spark, docs):
    plan = sharding.shard(docs(shard_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n in entry.queries() if n.startswith("op")] == sorted(
        (n for n in entry.queries() if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0])) and len(
        [n for n in entry.queries() if n.startswith("op")]) == 13


@pytest.fixture(scope="module")
def staged(spark):
    """What each stage returns over the smallest table, with rows no table has added to it."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, None, None, 0), (9001, "", "en", "s", 0), (9002, "12345 !!", "en", None, 8),
                                 (None, "a b", None, "s", 3)], docs.schema)
    out = [docs.union(odd).collect()]
    at = docs.union(odd)
    for _, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.written(stage(spark, at, SF_SMALL), "stage")
        out.append(at.collect())
    return out


def test_language_stage_rejects_what_has_no_language(staged):
    before, after = staged[0], staged[1]
    gone = Counter(r.doc_id for r in before) - Counter(r.doc_id for r in after)
    assert set(gone) >= {9000, 9001, 9002} and len(gone) <= 4
    assert after[0].__fields__ == before[0].__fields__


def test_stages_carry_columns_with_clashing_names(spark, docs):
    rows = [(i, f"the words of number {i} are these and the rest is like that", "en") for i in range(1, 30)]
    at = docs(rows, score=1, lang_pred="x", keep_id=2, kept=True, fp=3, rate=0.5, tokens="t", posterior="p", sequence_id=9, length="l")
    names = at.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.written(stage(spark, at, SF_SMALL), "clash")
        assert at.columns == names
    assert corpus_pipeline.STAGES[-1][1](spark, at, SF_SMALL).count() > 0


def test_stages_of_an_empty_table(spark, docs):
    at = docs([])
    for _, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.written(stage(spark, at, SF_SMALL), "empty")
        assert at.count() == 0


def test_exact_stage_against_brute_force(staged):
    before, after = staged[1], staged[2]
    groups = {}
    for r in before:
        groups.setdefault(WHITE.sub("", r.text or ""), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == sorted(min(g)[1:] for g in groups.values())


def test_near_stage_against_brute_force(staged):
    before, after = staged[2], staged[3]
    roots = brute_components({brute_print(r.text) for r in before}, 3)
    first = {}
    for r in before:
        key, me = roots[brute_print(r.text)], (r.doc_id is None, r.doc_id or 0)
        first[key] = min(me, first.get(key, me))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == sorted(first.values())


def test_mixing_stage_repeats_documents(staged):
    before, after = staged[3], staged[4]
    copies = Counter(r.doc_id for r in after)
    assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) >= 1
    assert after[0].__fields__ == before[0].__fields__


def test_packing_stage(staged):
    before, after = staged[4], staged[5]
    once = {r.doc_id: r.text for r in before}
    tokens = sum(len(encoder().encode(r.text)) // 4 for r in before)
    assert sum(r.length for r in after) == tokens
    singles = {d for d, n in Counter(r.doc_id for r in before).items() if n == 1}
    if len(singles) == len(before):
        check_packed(list(once.items()), after, 2048)
