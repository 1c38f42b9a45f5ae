"""Secrets, collocations and vector codes over odd rows and hard cases, against brute force."""

import random

import numpy as np
import pytest

from tabweave.llm import phrases, secrets, vector_codes
from tests.llm import brute, odd

KEY = "aZ3kQ9xW1vB7nM5pL0tR8yU2"
SECRETS = [
    'password = "hunter22"; passwd:abc; Secret\' = \'x1y2z3w4', "token=token=abcdefgh api-key: nothing API_KEY : short1 apikey=abcde",
    "secret=token:abcdefghi", "the token of a password, no secret", "AKIA" + "Z9" * 8, "AKIAAKIA" + "Q" * 11, "xAKIA" + "1" * 16,
    "0123456789abcdef01234567", "0123456789abcdef0123456", "é漢 " + "ab" * 20 + " é", "ABCDEF0123456789" * 2, KEY,
    f"see {KEY}, and --{KEY}--", f"token: {KEY}", "123e4567-e89b-12d3-a456-426614174000", "sha256-" + KEY * 2, "2024-05-06/2024-05-07_12",
    "internationalization_of_words", "a" * 900, "=" * 300, KEY * 40, "k" + KEY + "=" * 5, "toſecret=abcdefgh Key=abcdefgh",
    "token" + " " * 3000 + "x", "token" + " " * 3000 + "=" + " " * 50 + "'abcdefg'",
]


def found(df):
    return sorted(((r.doc_id, [(s.start, s.end, s.kind) for s in r.spans]) for r in df.collect()), key=repr)


def test_secrets_of_hard_texts(spark):
    rows = list(enumerate(SECRETS)) + odd.texts()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, spans int").repartition(3)
    want = sorted(((d, brute.secrets(t)) for d, t in rows), key=repr)
    assert found(secrets.find_secrets(docs)) == want
    kinds = {k for _, spans in want for *_, k in spans}
    assert kinds == set(secrets.KINDS)
    assert secrets.find_secrets(odd.none(spark)).count() == 0
    # A threshold of 0 leaves the known forms.
    assert found(secrets.find_secrets(docs, ratio=0.0)) == sorted(((d, brute.secrets(t, True)) for d, t in rows), key=repr)


def test_random_strings_are_told_from_words_and_digests():
    with open(secrets.VOCABULARY, "rb") as file:
        encoding = secrets._encoding(file.read())
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(letters, k=rng.randrange(24, 60))) for _ in range(500)]
    assert sum(bool(secrets.spans_of(k, encoding)) for k in keys) >= 495
    calm = ["responsibilities_of_the_management", "get_customer_order_history_by_date", "Donaudampfschifffahrtsgesellschaft", "f" * 40]
    assert not any(s[2] == "token" for w in calm for s in secrets.spans_of(w, encoding))


def test_a_vocabulary_has_a_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(secrets, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="more than 10 bytes"):
        secrets.find_secrets(odd.docs(spark))


def phrase_rows():
    rng = random.Random(9)
    common = ["new york city hall", "a b a b a b", "in spite of the fact", "x x x x x x x", "one two three four five six"]
    out = []
    for i in range(160):
        parts = [rng.choice(common) if rng.random() < 0.5 else " ".join(rng.choices("uvwxyz", k=rng.randrange(6))) for _ in range(8)]
        out.append((rng.choice([". ", "\n", "!?", " ", "\t", ", "]).join(parts), [None, "en", "de", "und", "e\tn"][i % 5]))
    return [*out, (None, "en"), ("", None), (" \t ", "fr"), ("New York CITY hall" * 3, "en"), ("é漢 é漢 " * 40, "zh")]


@pytest.mark.parametrize("bound", [200_000, 0])
def test_collocations(spark, monkeypatch, bound):
    monkeypatch.setattr(phrases, "BLOCK", 150)
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 7, "z") for r in rows], "text string, lang string, n int, block string").repartition(3, "text")
    for least, covered in ((12, 100), (3, 60)):
        got = phrases.top_collocations(docs, most=25, least=least, covered=covered, bound=bound)
        want = brute.collocations(rows, least, covered=covered, most=25)
        assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 20
        if not bound:
            break


def test_collocations_of_nothing(spark):
    assert phrases.top_collocations(odd.none(spark)).count() == 0
    assert phrases.top_collocations(odd.docs(spark), least=10_000_000).count() == 0
    got = phrases.top_collocations(odd.docs(spark), least=2).collect()
    assert sorted(map(tuple, got)) == sorted(brute.collocations([(t, r[2]) for (_, t), r in zip(odd.texts(), odd.rows(), strict=True)], 2))


def test_scores_are_exact_beyond_64_bits(spark):
    # 1000 a n is beyond a long already at these counts.
    frame = spark.createDataFrame([(3_000_000_000_001, 9_007_199_254_740_993, 3_000_000_000_007, 3_000_000_000_011)], "a long, n long, l long, r long")
    wide = {c: f"CAST({c} AS DECIMAL(16,0))" for c in "anlr"}
    got = frame.selectExpr(f"(CAST(1000 AS DECIMAL(4,0)) * {wide['a']} * {wide['n']}) DIV ({wide['l']} * {wide['r']}) AS s").first().s
    assert got == 1000 * 3_000_000_000_001 * 9_007_199_254_740_993 // (3_000_000_000_007 * 3_000_000_000_011)


def vector_rows(n=400, width=24):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.4, (12, width))
    rows = [(int(i), (centres[i % 12] + rng.normal(0, 0.02, width)).tolist(), i % 5 if i % 7 else None) for i in range(n)]
    # A third of all rows is one vector, the first entries of the codebook among them.
    rows = [(i, rows[1][1] if i % 3 == 1 else v, label) for i, v, label in rows]
    rows += [(3, rows[5][1], 1), (3, rows[3][1], 1), (None, rows[8][1], None), (n, None, 1), (n + 1, [float("nan")] * width, 1)]
    return rows + [(n + 2, [None, *rows[0][1][1:]], 2), (n + 3, [float("inf"), *rows[0][1][1:]], 2), (-5, rows[0][1], 99)]


SCHEMA = "vec_id long, embedding array<double>, label int"


def codes(df):
    got, books = df
    return sorted((tuple(r)[:1] + (r.code, r.error, r.label_error) for r in got.collect()), key=repr), [b.tolist() for b in books]


@pytest.mark.parametrize("leaf, block", [(24, 4096), (2, 37)])
def test_vector_codes(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rows = vector_rows()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, error int").repartition(3, "label")
    got, books = codes(vector_codes.compress(frame))
    want, whole = brute.vector_codes(rows)
    assert got == sorted(want, key=repr) and books == whole


def test_vector_codes_of_few_and_odd_vectors(spark):
    few = vector_rows()[:5]
    want, books = brute.vector_codes(few)
    assert codes(vector_codes.compress(spark.createDataFrame(few, SCHEMA))) == (sorted(want, key=repr), books)
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA))[0].count() == 0
    # Parts of unequal length, and vectors without components.
    short = [(i, [i / 3, -i / 7, 0.5], None) for i in range(30)]
    want, books = brute.vector_codes(short)
    assert codes(vector_codes.compress(spark.createDataFrame(short, SCHEMA))) == (sorted(want, key=repr), books)
    empty, _ = codes(vector_codes.compress(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)))
    assert empty == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    for rows, error in (([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], "components"), ([(1, [1e12] * 8, 1)], "stay below")):
        with pytest.raises(Exception, match=error):
            vector_codes.compress(spark.createDataFrame(rows, SCHEMA))


def test_whole_subtrees_are_assigned_by_the_triangle_inequality():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, (16, 8))
    points = (centres[rng.integers(0, 16, 3000)] + rng.integers(-60, 60, (3000, 8))).astype(np.int64)
    tree = vector_codes.cover_tree(points)
    ordered, entries = points[tree["order"]], np.full(3000, -1)
    alone = 0
    for low, high, entry in vector_codes.assigned_ranges(tree, ordered, centres):
        for a, b, e in zip(low, high, entry, strict=True):
            assert (entries[a:b] == -1).all()
            entries[a:b] = e
            alone += b - a == 1
    assert (entries == vector_codes._nearest(ordered, centres)[0]).all() and alone < 300
    # Every node's points are within its reach, children are apart by half of it.
    for i in range(len(tree["low"])):
        here = ordered[tree["low"][i] : tree["high"][i]]
        assert np.sqrt(vector_codes._squares(here, here[0]).max()) <= tree["reach"][i] + 1e-6
        kids = ordered[tree["low"][tree["first"][i] : tree["first"][i] + tree["n"][i]]]
        apart = [np.sqrt(((a - b) ** 2).sum()) for j, a in enumerate(kids) for b in kids[:j]]
        assert all(d > tree["reach"][i] / 2 - 1e-6 for d in apart)
