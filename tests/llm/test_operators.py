"""Every operator over odd documents, against brute force."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F
from tabweave.llm import anchors, decontaminate, fm_dedup, graph, licenses, mixing, quality, sharding, simhash, suffix_dedup, topk, urls
from tabweave.llm.queries import CURRICULUM, URL_RULES
from tests.llm import brute, odd

KEYED = ("lang", "source", "n_chars", "shard", "score", "_key", "rank")


def as_tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def tree_rows(tree):
    return [(leaf.region, leaf.rack, leaf.shard, leaf.weight) for leaf in tree]


def test_shards_follow_the_draws_and_slots_have_no_gaps(spark):
    tree = sharding.grown_tree(sharding.balanced_tree(6))
    placed = sharding.shard_documents(odd.docs(spark), tree)
    assert sorted(placed.columns) == sorted([*odd.docs(spark).columns, "slot"])
    found = placed.select("doc_id", "shard", "slot").collect()
    assert len(found) == len(odd.texts())
    slots = defaultdict(list)
    for r in found:
        assert r.shard == brute.draws("" if r.doc_id is None else str(r.doc_id), tree_rows(tree))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(odd.none(spark), tree).count() == 0


def test_a_new_shard_takes_rows_only_into_itself_and_weights_move_few(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = sharding.balanced_tree(16)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else x.weight) for x in tree]
    both = sharding.shard_of(keys, "doc_id", tree, "old")
    both = sharding.shard_of(sharding.shard_of(both, "doc_id", sharding.grown_tree(tree), "new"), "doc_id", heavier, "heavy")
    rows = both.collect()
    moved = [r for r in rows if r.old != r.new]
    assert moved and all(r.new == 16 for r in moved) and len(moved) < 400
    # A heavier shard moves rows only into the subtrees above it.
    assert all(r.heavy // 4 == 1 for r in rows if r.old != r.heavy)
    counts = np.bincount([r.old for r in rows], minlength=16)
    assert counts.min() > 180 and counts.max() < 330


def test_a_tree_needs_weights(spark):
    with pytest.raises(ValueError, match="weights"):
        sharding.shard_of(odd.docs(spark), "doc_id", [sharding.Leaf("r", "k", 0, 0.0)], "shard")


def sizes_and_targets(rows, weights, share=1.5, most=2.0):
    """Targets by the rule as it is told: cap, share the excess again by weight, until none is above."""
    sizes = defaultdict(int)
    for _, text, _, source, *_ in rows:
        sizes[source] += len(brute.SPACE.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    whole, capped, target = share * sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in order if s not in capped]
        left = whole - sum(capped.values())
        target = capped | {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if target[s] > most * sizes[s]]
        if not over:
            return sizes, target
        capped |= {s: most * sizes[s] for s in over}


def test_mix_meets_its_targets_in_the_order_of_the_schedules(spark):
    mixed = mixing.mix_sources(odd.docs(spark), CURRICULUM)
    rows = mixed.collect()
    sizes, target = sizes_and_targets(odd.rows(), [3, 1, 2])
    taken = defaultdict(int)
    for r in rows:
        assert r.size == len(brute.SPACE.findall(r.text or ""))
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) == (-(-r.taken // r.size) if r.size else 0)
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(target[s] + 0.5) for s in sizes)
    again = mixing.mix_sources(odd.docs(spark).repartition(5), CURRICULUM)
    pick = ["doc_id", "source", "size", "taken", "positions"]
    assert as_tuples(again.select(pick)) == as_tuples(mixed.select(pick))
    order = mixing.training_order(mixed)
    assert order.columns == [c for c in mixed.columns if c not in ("size", "source_size", "target", "taken", "positions")]
    got = defaultdict(int)
    for r in order.collect():
        got[r.source] += len(brute.SPACE.findall(r.text))
    assert got == {s: n for s, n in taken.items() if n}
    assert mixing.mix_sources(odd.none(spark), CURRICULUM).count() == 0


def test_schedules_invert_their_integral(spark):
    schedule = [(0.0, 2.0), (0.25, 0.0), (0.5, 0.0), (1.0, 1.0)]
    shares = [0.0, 0.1, 0.5, 0.6, 0.99, 1.0]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    times = [r.t for r in df.select("s", mixing._time_of(schedule, F.col("s")).alias("t")).orderBy("s").collect()]
    grid = np.linspace(0, 1, 200_001)
    spent = np.concatenate([[0], np.cumsum((np.interp(grid[1:], *zip(*schedule)) + np.interp(grid[:-1], *zip(*schedule))) / 2)])
    for share, time in zip(shares, times):
        assert np.interp(time, grid, spent / spent[-1]) == pytest.approx(share, abs=1e-4)
    with pytest.raises(ValueError, match="schedule"):
        mixing.mix_sources(odd.docs(spark), [[(0.0, 1.0), (0.5, 1.0)]])


def test_repeated_words(spark):
    found = fm_dedup.remove_repeated_windows(odd.docs(spark))
    got = [
        (r.doc_id, r.size, sum(s.high - s.low for s in r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found.collect()
    ]
    assert sorted(got, key=repr) == sorted(brute.repeated_words(odd.texts()), key=repr)
    assert set(KEYED) <= set(found.columns)
    assert fm_dedup.remove_repeated_windows(odd.none(spark)).count() == 0


def test_windows_of_words_with_equal_hashes_differ(spark):
    pair = ["https://example.org/p/55354", "https://example.org/p/110916"]
    assert fm_dedup.word_codes(" ".join(pair).encode()).tolist() == fm_dedup.word_codes(" ".join(pair[::-1]).encode()).tolist()
    fixed = odd.words(19, 9)
    texts = [(i, " ".join([*fixed[:at], word, *fixed[at:]])) for i, (at, word) in enumerate((a, w) for a in (0, 10, 19) for w in pair)]
    texts += [(6, texts[3][1])]
    found = fm_dedup.remove_repeated_windows(spark.createDataFrame(texts, "doc_id long, text string"))
    got = [(r.doc_id, r.size, sum(s.high - s.low for s in r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found.collect()]
    assert sorted(got) == sorted(brute.repeated_words(texts)) and [n for _, _, n, _ in sorted(got)] == [0] * 6 + [20]


def test_repeated_bytes(spark):
    found = suffix_dedup.remove_repeated_strings(odd.docs(spark))
    got = [
        (r.doc_id, r.size, sum(s.high - s.low for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == sorted(brute.repeated_bytes(odd.texts()), key=repr)
    assert suffix_dedup.remove_repeated_strings(odd.none(spark)).count() == 0


def shared_passage(n=90):
    """A third of the texts has one passage, whole or in part, within words of their own; some are copies."""
    passage = odd.words(75, 21, 50_000)
    out = []
    for i in range(n):
        own = odd.words(60, 100 + i, 50_000)
        cut = passage[i % 7 :] if i % 2 else passage[: 75 - i % 5]
        out.append((i * 7 % n, " ".join([*own[:30], *(cut if i % 3 == 0 else []), *own[30:]])))
    return [*out, (n, out[3][1]), (None, out[6][1]), (4, out[9][1]), (4, out[9][1])]


@pytest.mark.parametrize("hot, held", [(2, 64 << 20), (20, 64 << 20), (2, 4_000)])
def test_windows_of_hot_anchors_are_dealt_out_one_by_one(spark, monkeypatch, hot, held):
    monkeypatch.setattr(anchors, "HOT_PLACES", hot)
    monkeypatch.setattr(anchors, "HELD", held)
    for texts in (shared_passage(), odd.texts()):
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
        words = fm_dedup.remove_repeated_windows(docs).collect()
        got = [(r.doc_id, r.size, sum(s.high - s.low for s in r.spans), hashlib.sha256(r.kept).hexdigest()) for r in words]
        assert sorted(got, key=repr) == sorted(brute.repeated_words(texts), key=repr)
        strings = suffix_dedup.remove_repeated_strings(docs).collect()
        got = [(r.doc_id, r.size, sum(s.high - s.low for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in strings]
        assert sorted(got, key=repr) == sorted(brute.repeated_bytes(texts), key=repr)


def test_hot_anchors_are_found(spark):
    docs = spark.createDataFrame(shared_passage(), "doc_id long, text string")
    rows = docs.select(F.col("text").cast("binary").alias("text"))
    assert len(anchors.repeated_anchors(rows, fm_dedup.SCHEME)[1]) == 0


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 3, 4, 5, 6, 7, *rng.integers(8, 90, 60).tolist()]:
        text = rng.integers(1, int(rng.integers(2, 6)), n)
        assert suffix_dedup.suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_fm_index_counts_occurrences():
    rng = np.random.default_rng(6)
    text = np.append(rng.integers(1, 4, 400), 0)
    index = fm_dedup.FmIndex(text, 6)
    for _ in range(50):
        pattern = rng.integers(1, 4, int(rng.integers(1, 7)))
        low, high = np.array([0]), np.array([len(text)])
        for c in pattern[::-1]:
            low, high = index.step(low, high, np.array([c]))
        want = sum(text[i : i + len(pattern)].tolist() == pattern.tolist() for i in range(len(text)))
        assert high[0] - low[0] == want


def test_leaks(spark):
    items = [(100, odd.PASSAGE), (101, "nothing of the kind is in any document at all"), (102, None), (103, ""),
             (104, "ONE"), (None, odd.PASSAGE), (100, odd.PASSAGE), (105, " ".join(odd.PASSAGE.split()[:50] + odd.words(10, 77)))]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for block in (500_000, 30):
        found = decontaminate.find_leaks(odd.docs(spark), table, block_words=block)
        got = sorted(((r.doc_id, r.item_id, r.shared) for r in found.collect()), key=repr)
        assert got == sorted(brute.leaks(odd.texts(), items), key=repr)
        kept = decontaminate.drop_leaks(odd.docs(spark), table, block_words=block)
        dirty = {d for d, _, _ in got}
        assert kept.columns == odd.docs(spark).columns
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((d for d, _ in odd.texts() if d not in dirty), key=repr)
    # A short item is found within longer texts, where its words stand together.
    short = spark.createDataFrame([(1, "Forty two!"), (2, "answer is forty two"), (3, "two forty")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "The answer is forty-two, they say."), (2, "forty or two"), (3, "forty two")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.containment) for r in decontaminate.find_leaks(texts, short).collect())
    assert got == [(1, 1, 1.0), (1, 2, 1.0), (3, 1, 1.0)]
    assert decontaminate.find_leaks(odd.docs(spark), table.limit(0)).count() == 0
    assert decontaminate.find_leaks(odd.none(spark), table).count() == 0


def test_sketches_never_miss():
    for n in range(1, 400):
        missing = n - decontaminate.least_shared(n, 0.8)
        assert min(n, decontaminate.sketch_size(n, 0.8)) > missing


def test_url_verdicts(spark):
    pages = [(1, "https://a.Example.ORG/es/1"), (2, "http://example.org/en/12?q"), (3, "http://example.org/en/2"), (4, None),
             (5, ""), (6, "no scheme"), (7, "http://x.com/fr/a#b"), (8, "http://x.com/de/"), (9, "http://notexample.org"),
             (10, "ftp://é.com/fr/%"), (11, "http://b.net/" + "x" * 3000), (12, "http://x.com/de/"), (None, "http://com/fr/")]
    table = spark.createDataFrame([(*p, "v") for p in pages], "page_id long, url string, score string")
    found = {r.page_id: r for r in urls.filter_urls(table, URL_RULES).collect()}
    rules = {1: "example.org/es/", 2: "example.org/en/1", 3: "org/", 7: "com/fr/", 8: "com/de/", 10: "com/fr/", 12: "com/de/", None: "com/fr/"}
    assert {k: r.rule for k, r in found.items()} == {k: rules.get(k) for k, _ in pages}
    assert [found[k].verdict for k in (1, 2, 3, 7, 8)] == ["block", "block", "allow", "allow", "block"]
    assert (found[1].host, found[1].path) == ("a.example.org", "/es/1") and (found[4].host, found[6].path) == ("", "")
    assert found[9].path == "" and found[9].rule is None
    assert all(r.verdict in ("allow", "block") for r in found.values())
    assert urls.filter_urls(table.limit(0), URL_RULES).count() == 0
    # Of examples of one class only, all others get that class.
    blocked = urls.filter_urls(table.filter("page_id IN (1, 5)"), URL_RULES)
    assert {r.verdict for r in blocked.collect()} == {"block"}


def markov_values(texts, order=5, prior=4.0):
    """Difference of log-probabilities by run, by the definition."""
    counts = [defaultdict(float), defaultdict(float)]
    for text, allow in texts:
        padded = "\x02" * (order - 1) + text
        for i in range(order - 1, len(padded)):
            for n in range(1, order + 1):
                counts[not allow][padded[i - n + 1 : i + 1]] += 1

    def context(c, ctx):
        return sum(v for run, v in c.items() if run[:-1] == ctx)

    def chance(c, run):
        if not run:
            return 1 / 256
        return (c.get(run, 0.0) + prior * chance(c, run[1:])) / (context(c, run[:-1]) + prior)

    every = set(counts[0]) | set(counts[1])
    return {run: math.log(chance(counts[0], run)) - math.log(chance(counts[1], run)) for run in every}


def test_url_models_are_smoothed_counts(spark):
    texts = [("ab.c/x", True), ("ab.d/é", True), ("ab.d/y", False), ("zz.c/x", False)]
    df = spark.createDataFrame(texts, "t string, allow boolean").select(urls._padded(F.col("t")).alias("chars"), "allow")
    got = {r.run: r.value for r in urls.run_values(df, "chars", "allow").collect()}
    want = markov_values(texts)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_url_scores_use_every_run(spark):
    rng = np.random.default_rng(8)
    hosts = [("x.com", True), ("y.com", False)]
    parts = {True: "/fr/", False: "/de/"}
    texts = [(h + parts[a] + "".join(map(chr, rng.integers(97, 123, 50))), a) for h, a in hosts for _ in range(60)]
    counts, contexts = (defaultdict(lambda: [0, 0]) for _ in range(2))
    held = {t for t, _ in texts if brute.signed_hash(t) % 5 == 0}
    for text, allow in texts:
        if text in held:
            continue
        padded = "\x02" * 4 + text
        for run in (padded[i - n + 1 : i + 1] for i in range(4, len(padded)) for n in range(1, 6)):
            counts[run][not allow] += 1
            contexts[run[:-1]][not allow] += 1

    def chance(run, k):
        return (counts[run][k] + 4 * chance(run[1:], k)) / (contexts[run[:-1]][k] + 4) if run else 1 / 256

    def score(text):
        padded, total = "\x02" * 4 + text, 0
        for i in range(4, len(padded)):
            run = next((r for r in (padded[i - n + 1 : i + 1] for n in range(5, 0, -1)) if r in counts), None)
            total += math.log(chance(run, 0) / chance(run, 1)) if run else 0
        return total / len(text)

    texts += [("z.net/" + "".join(map(chr, rng.integers(97, 123, 50))), None) for _ in range(20)]
    known = {t: score(t) for t, _ in texts}
    table = spark.createDataFrame([(i, f"http://{t}") for i, (t, _) in enumerate(texts)], "page_id long, url string")
    got = urls.filter_urls(table, URL_RULES).collect()
    assert len(got) == len(texts) and all(r.score == pytest.approx(known[r.host + r.path], abs=1e-8) for r in got)
    of = [np.array([known[t] for t, allow in texts if allow is a and t in held]) for a in (True, False)]
    assert all(len(x) > 4 for x in of)
    near, far = of[1].std() + 1e-9, of[0].std() + 1e-9
    threshold = (of[1].mean() * far + of[0].mean() * near) / (near + far)
    assert all((r.verdict == "allow") == (r.score >= threshold) for r in got if r.rule is None)


def test_license_scan(spark):
    scan = licenses.scan_licenses(odd.docs(spark))
    for r in scan.collect():
        found = brute.ALNUM.findall((r.text or "").translate(brute.LOWER))
        assert r.n_words == len(found)
        want = sorted((i, i + len(p.split()) - 1, licenses.BASE[p]) for i, p in brute.phrase_places(found, licenses.BASE))
        assert sorted((b.first, b.last, b.label) for b in r.base) == want
    assert licenses.scan_licenses(odd.none(spark)).count() == 0


CASES = {
    "Licensed under the Apache License, Version 2.0 (the License)": {"apache-2.0", "apache"},
    "under the terms of the GNU General Public License version 3 or later": {"gpl-3.0", "gpl"},
    "SPDX-License-Identifier: MIT": {"mit"},
    "Creative Commons Attribution-ShareAlike 4.0 International": {"cc-by-sa-4.0"},
    "CC BY-NC-ND 3.0": {"cc-by-nc-nd-3.0"},
    "Released under the MIT License. Copyright (c) 2019-2021": {"mit", "copyright"},
    "THE MIT LICENSE, the mit license; no license": {"mit"},
    "mitlicense and licenses": set(),
}


def test_license_labels_and_suppression(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "text string")
    got = {r.text: {d.label for d in r.detections} for r in licenses.scan_licenses(df).collect()}
    assert got == CASES
    for r in licenses.scan_licenses(df).collect():
        spans = [(d.first, d.last) for d in r.detections]
        assert len(spans) == len(set(spans))


def test_license_rules_hold_their_keyword_and_a_gate():
    made = licenses.rules()
    assert 300 < len(made) < 600
    assert all(any(g in r.pattern for g in licenses.GATES) for r in made)


def test_quality(spark):
    rng = np.random.default_rng(0)
    good = [(i, " ".join(odd.words(int(rng.integers(40, 90)), i)) + ".", 1) for i in range(100, 160)]
    bad = [(i, " | ".join(w.upper() + "!!" for w in odd.words(int(rng.integers(40, 90)), i)), 0) for i in range(200, 260)]
    rows = [(d, t, None) for d, t in odd.texts()] + good + bad
    docs = spark.createDataFrame([(d, t, "s") for d, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(d, q) for d, _, q in rows] + [(100, 1), (999, 0)], "doc_id long, quality int")
    learnt = labels.filter(F.col("doc_id") % 3 > 0)
    model = quality.fit_quality(docs, learnt)
    scored = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scored.values())
    held = [(scored[d] >= 0.5) == (q == 1) for d, _, q in good + bad if d % 3 == 0]
    assert np.mean(held) > 0.95
    kept = quality.keep_quality(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.count() == sum(
        1 for r in quality.score_quality(docs, model).collect() if r.score >= 0.3
    )
    empty = quality.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, empty).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).count() == 0
    few = quality.fit_quality(docs, learnt, most=10)
    assert len(few.labels) == 10


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(1)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    vectors, labels = unit(rng.normal(size=(50, 8))), rng.integers(0, 2, 50).astype(float)
    model = quality.Model(np.eye(8), vectors, labels, 7)
    asked = unit(rng.normal(size=(20, 8)))
    for a, score in zip(asked, model.vote(asked)):
        near = sorted(range(50), key=lambda i: -vectors[i] @ a)[:7]
        w = [max(vectors[i] @ a, 0) ** 8 for i in near]
        assert score == pytest.approx(sum(x * labels[i] for x, i in zip(w, near)) / sum(w))


@pytest.mark.parametrize("big", [False, True])
def test_top_k(spark, monkeypatch, big):
    rng = np.random.default_rng(2)
    scale = 3e5 if big else 1.0
    vectors = [(i, (rng.normal(size=4) * scale).tolist()) for i in range(60)] + [(i, [scale] * 4) for i in range(60, 90)]
    vectors += [(90, None), (91, [None, 1.0, 1.0, 1.0]), (92, [float("nan")] * 4), (93, [float("inf")] * 4), (94, []),
                (95, [1.0, 2.0]), (100, [2.0, 1.0]), (None, [1.0] * 4), (61, [scale] * 4)]
    table = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<double>, rank int").repartition(20)
    # Several blocks, shards and tiles of either.
    for name, n in (("LEAST_SHARD", 7), ("SHARD", 7), ("QUERIES", 1), ("TILE", 3)):
        monkeypatch.setattr(topk, name, n)
    got = topk.top_k(table, F.col("vec_id") % 20 == 0, 5, query_block=2)
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, v in usable:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0, 5).count() == 0


def test_near_duplicates(spark):
    found = simhash.near_duplicates(odd.docs(spark))
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute.simhash_components(odd.texts()), key=repr)
    assert simhash.near_duplicates(odd.none(spark)).count() == 0
    kept = simhash.keep_one(odd.docs(spark))
    assert kept.columns == odd.docs(spark).columns
    named = {c for _, _, c in got if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(named) and ids.count(None) == 2


@pytest.mark.parametrize("dense", [simhash.DENSE, 10, 0])
def test_fingerprints_at_two_bits_are_linked_and_at_three_are_not(spark, monkeypatch, dense):
    # Without dense cells, with the few around the crowd, and with every cell refined by Spark.
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = np.random.default_rng(3)
    prints = set(rng.integers(0, 2**63, 300).tolist())
    for p in list(prints)[:60]:
        near = p
        for bits in range(1, 4):
            near = p
            for b in rng.choice(64, bits, replace=False):
                near ^= 1 << int(b)
            prints.add(near)
    # A dense cell: all neighbours of one fingerprint, so that it is refined to single bits.
    prints |= {5 ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)} | {5 ^ (1 << 3) ^ (1 << 9) ^ (1 << 20)}
    prints = sorted({p - (1 << 64) if p >= 1 << 63 else p for p in prints})
    values = np.array(prints, np.int64).view(np.uint64)
    label = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    while True:
        after = np.where(near, label[None, :], len(label)).min(axis=1)
        if (after == label).all():
            break
        label = after
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    assert (simhash.dense_cells(frame).count() > 0) == (dense < simhash.PAIRWISE)
    links = simhash.links(frame)
    roots = {r.node: r.root for r in graph.components(links, "a", "b").collect()}
    got = defaultdict(set)
    for i, p in enumerate(prints):
        got[roots.get(p, p)].add(i)
    want = defaultdict(set)
    for i, x in enumerate(label):
        want[x].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_stars_and_nothing(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (300, 200), (200, 300)]
    links = spark.createDataFrame(pairs, "a long, b long")
    roots = {r.node: r.root for r in graph.components(links, "a", "b").collect()}
    assert roots == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {300: 200}
    assert graph.components(links.limit(0), "a", "b").count() == 0


def test_held_out_rows_are_a_fifth():
    assert 150 < sum(brute.in_fifth(i) for i in range(1000)) < 250 and zlib.crc32(b"") % 5 == 0
