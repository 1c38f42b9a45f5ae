"""The pipeline's stages one after the other over odd and over empty documents."""

from collections import Counter, defaultdict

import corpus_pipeline
from tabweave.llm import sharding
from tests.llm import brute, odd


def chain(spark, sf, docs, tmp_path):
    """Columns and rows behind each stage, each written and read again."""
    seen, frame = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, sf).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        seen[name] = (frame.columns, frame.collect())
    return seen


def pairs(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=repr)


def test_stages_over_odd_documents(spark, sf, tmp_path):
    docs = odd.docs(spark)
    seen = chain(spark, sf, docs, tmp_path)
    kept = [r for _, rows in seen.values() for r in rows]
    assert kept and all(columns == docs.columns for columns, _ in list(seen.values())[:3])
    good = pairs(seen["quality"][1])
    assert not Counter(good) - Counter(odd.texts())
    # Of each group the least key stays, one row of it, and all rows without a key.
    names = {c for _, _, c in brute.simhash_components(good) if c is not None}
    distinct = pairs(seen["near_dedup"][1])
    assert sorted(d for d, _ in distinct if d is not None) == sorted(names)
    assert [t for d, t in distinct if d is None] == [t for d, t in good if d is None]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    dirty = {d for d, _, _ in brute.leaks(distinct, items)}
    assert pairs(seen["decontaminate"][1]) == [(d, t) for d, t in distinct if d not in dirty]
    whole, taken = defaultdict(int), defaultdict(int)
    for name, sums in (("decontaminate", whole), ("mix", taken)):
        for r in seen[name][1]:
            sums[r.source] += len(brute.SPACE.findall(r.text or ""))
    assert all(taken[s] <= 2 * whole[s] + 1 for s in taken) and abs(sum(taken.values()) - 1.5 * sum(whole.values())) <= len(whole)
    assert all(r.text.split() for r in seen["mix"][1])
    tree = [(leaf.region, leaf.rack, leaf.shard, leaf.weight) for leaf in sharding.balanced_tree(16)]
    slots = defaultdict(list)
    for r in seen["shard"][1]:
        assert r.shard == brute.draws("" if r.doc_id is None else str(r.doc_id), tree)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(map(len, slots.values())) == len(seen["mix"][1])


def test_stages_over_no_documents(spark, sf, tmp_path):
    seen = chain(spark, sf, odd.none(spark), tmp_path)
    assert all(not rows for _, rows in seen.values())
    assert seen["decontaminate"][0] == odd.none(spark).columns and {"shard", "slot"} <= set(seen["shard"][0])


def test_stages_over_documents_without_texts(spark, sf, tmp_path):
    docs = odd.docs(spark).selectExpr("doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")
    seen = chain(spark, sf, docs, tmp_path)
    # One document of the group without words, and those without a key; none has words to be mixed.
    left = [r.doc_id for r in seen["near_dedup"][1]]
    assert [d for d in left if d is not None] == [1] or not seen["quality"][1]
    assert not seen["mix"][1] and not seen["shard"][1]
