"""The registered queries over the whole smallest tables, against brute force and held-out labels."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tabweave.llm import licenses, sharding
from tests.llm import brute

BASES = licenses.BASE


@pytest.fixture(scope="module")
def tables(spark, sf):
    return {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "pages", "benchmark")}


@pytest.fixture(scope="module")
def docs(tables):
    return [(r.doc_id, r.text) for r in tables["documents"].collect()]


def rows(spark, sf, name):
    return entry.queries()[name](spark, sf).collect()


def tree_rows(tree):
    return [(leaf.region, leaf.rack, leaf.shard, leaf.weight) for leaf in tree]


def test_op1(spark, sf, docs):
    got = {r.doc_id: r for r in rows(spark, sf, "op1_hash_tree")}
    assert len(got) == len(docs)
    tree = sharding.balanced_tree(16)
    slots = defaultdict(list)
    for d, t in docs:
        r, text = got[d], (t or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "key")
        assert r.shard == brute.draws(str(d), tree_rows(tree))
        assert r.grown_shard == brute.draws(str(d), tree_rows(sharding.grown_tree(tree))) and r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize(
    "name, version",
    [("op2_fm_index", brute.repeated_words), ("op5_suffix_array", brute.repeated_bytes), ("op9_segment_grid", brute.simhash_components)],
)
def test_op2_op5_op9(spark, sf, docs, name, version):
    assert sorted(map(tuple, rows(spark, sf, name))) == sorted(version(docs))


def test_op3(spark, sf, docs, tables):
    items = [(r.item_id, r.text) for r in tables["benchmark"].collect()]
    assert sorted((r.doc_id, r.item_id, r.shared) for r in rows(spark, sf, "op3_containment")) == sorted(brute.leaks(docs, items))


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def test_op4(spark, sf, tables):
    got = {r.page_id: r for r in rows(spark, sf, "op4_url_ratio")}
    pages = tables["pages"].select("page_id", "url").collect()
    assert len(got) == len(pages)
    for p in pages:
        _, found, rest = (p.url or "").partition("://")
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = rest[:end].translate(brute.LOWER) if found else ""
        path = rest[end:].split("?")[0].split("#")[0] if found else ""
        fits = []
        for rule in RULES:
            h, _, q = rule.partition("/")
            if (host == h or host.endswith(f".{h}")) and path.startswith(f"/{q}"):
                fits.append(rule)
        best = max(fits, key=len, default=None)
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, best)
        assert r.verdict == RULES.get(best, r.verdict) and r.verdict in ("allow", "block")
    free = [r for r in got.values() if r.rule is None]
    assert free and {r.verdict for r in got.values()} == {"allow", "block"}


def test_op6(spark, sf, docs):
    got = {r.doc_id: r for r in rows(spark, sf, "op6_signature_rules")}
    for d, t in docs:
        words = brute.ALNUM.findall((t or "").translate(brute.LOWER))
        places = brute.phrase_places(words, BASES)
        starts = [i for i, _ in places]
        r = got[d]
        labels = sorted({BASES[p] for _, p in places})
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(labels))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert set(labels) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


def test_op7(spark, tables):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in rows(spark, sf, "op7_neighbour_vote")}
    assert all(r.held_out == brute.in_fifth(d) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for d, r in got.items())
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(got[d].score, q) for d, q in labels if brute.in_fifth(d)]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.9
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_pipeline_stage_by_stage(spark, sf, docs, tables, tmp_path):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "good_documents", "distinct_documents", "clean_documents", "mixed_documents", "sharded_documents"
    ]
    columns, frame, seen = tables["documents"].columns, tables["documents"], {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, sf).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        seen[name] = frame.collect()
        assert frame.columns[: len(columns)] == columns
    scores = {r.doc_id: r.predicted for r in rows(spark, sf, "op7_neighbour_vote")}
    good = [(d, t) for d, t in docs if scores[d]]
    assert sorted((r.doc_id, r.text) for r in seen["quality"]) == sorted(good)
    one = {c for _, _, c in brute.simhash_components(good)}
    assert sorted(r.doc_id for r in seen["near_dedup"]) == sorted(one)
    items = [(r.item_id, r.text) for r in tables["benchmark"].collect()]
    left = [(d, t) for d, t in good if d in one]
    dirty = {d for d, _, _ in brute.leaks(left, items)}
    assert dirty and sorted(r.doc_id for r in seen["decontaminate"]) == sorted(one - dirty)
    taken, whole = defaultdict(int), defaultdict(int)
    for r in seen["decontaminate"]:
        whole[r.source] += len(brute.SPACE.findall(r.text))
    for r in seen["mix"]:
        taken[r.source] += len(brute.SPACE.findall(r.text))
    assert abs(sum(taken.values()) - 1.5 * sum(whole.values())) <= len(whole)
    assert all(taken[s] <= 2 * whole[s] + 1 for s in taken)
    assert max(Counter(r.doc_id for r in seen["mix"]).values()) <= 2
    tree = tree_rows(sharding.balanced_tree(16))
    assert all(r.shard == brute.draws(str(r.doc_id), tree) for r in seen["shard"])
    assert len(seen["shard"]) == len(seen["mix"]) and len({(r.shard, r.slot) for r in seen["shard"]}) == len(seen["shard"])
    assert sorted((r.doc_id, r.shard) for r in rows(spark, sf, "pipeline")) == sorted((r.doc_id, r.shard) for r in seen["shard"])


def test_op11(spark, sf, docs):
    got = {r.doc_id: r for r in rows(spark, sf, "op11_token_efficiency")}
    assert len(got) == len(docs)
    for d, t in docs:
        spans = brute.secrets(t)
        known = [s for s in spans if s[2] != "token"]
        r, kinds = got[d], Counter(k for *_, k in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in known).encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
