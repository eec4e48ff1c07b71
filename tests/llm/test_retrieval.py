"""Hard negatives, whitening and benchmark passages: odd tables, against brute force."""

import math
import random
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import negatives, postings, whitening
from plumbline.llm.common import prepared, table
from plumbline.llm.queries import QUERIES

from . import brute
from .test_queries import same

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def session(spark):
    return prepared(spark)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def odd_vectors():
    """Ties, copies of one vector, NULLs, values that are not finite, other lengths, zero and negative scores."""
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(draw.normal(size=6))], int(draw.integers(0, 4))) for i in range(120)]
    rows += [(200 + i, [0.5] * 6, i % 3) for i in range(150)]
    rows += [(400, [0.0] * 6, 1), (401, [-0.5] * 6, 0), (500, [-0.5] * 6, 0), (600, None, 1), (601, [], 1), (602, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(603, [math.nan] + [0.0] * 5, 2), (604, [math.inf] + [0.0] * 5, 2), (605, [1.0] * 6, None), (None, [0.5] * 6, 0), (None, [0.5] * 6, 1)]
    rows += [(700, [1.0, 2.0], 1), (701, [1.0, 1.0], 1), (702, [0.5, 0.5], 2), (800, [1.0, 2.0, 3.0], 9)]
    return rows


# --- 11


def test_negatives(spark):
    rows = odd_vectors()
    df = frame(spark, rows, VECTORS).withColumns({"rank": F.lit(1), "score": F.lit("x"), "part": F.lit(0), "dim": F.lit(2)})
    assert same(negatives.mined(df, F.col("vec_id") % 100 == 0).collect(), brute.negatives(rows))


def test_repeated_ids_are_one_row(spark):
    rows = odd_vectors()
    again = [(100, [9.0] * 6, 3), (100, [0.0] * 6, 3), *rows[:40]]
    kept = {}
    for r in rows + again:
        if r[0] == 100:
            kept[100] = r if 100 not in kept or r[2] < kept[100][2] else kept[100]
    wanted = [r for r in rows if r[0] != 100] + [kept[100]]
    df = frame(spark, rows + again, VECTORS)
    assert same(negatives.mined(df, F.col("vec_id") % 100 == 0).collect(), brute.negatives(wanted))


def test_negatives_without_rows(spark):
    for rows in ([], [(100, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)]):
        assert negatives.mined(frame(spark, rows, VECTORS), F.col("vec_id") % 100 == 0).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 4), st.integers(30, 2500), st.booleans())
def test_tree_finds_the_best_rows(seed, dim, count, same_label):
    draw = np.random.default_rng(seed)
    q = draw.integers(-4, 5, (count, dim))
    labels = draw.integers(0, 3, count).astype(np.int32)
    order = negatives.packing(q, labels)
    assert sorted(order.tolist()) == list(range(count))
    tree = negatives.Tree(order.astype(np.int64), labels[order], q[order])
    own = draw.integers(0, count, 7)
    of = np.repeat(np.arange(7), 2)
    low, high = np.tile([-1000, 2], 7), np.tile([1000, 9], 7)
    x = negatives.Questions(own.astype(np.int64), labels[own], q[own].astype(float), of, low, high, np.arange(14))
    question, ids, scores = tree.search(x, 3, same_label)
    every = q[own] @ q.T
    for j in range(14):
        a = own[of[j]]
        fits = [(-int(every[of[j], i]), i) for i in range(count) if i != a and (labels[i] == labels[a]) == same_label and low[j] <= every[of[j], i] <= high[j]]
        assert [(-int(s), int(i)) for q_, i, s in zip(question, ids, scores, strict=True) if q_ == j] == sorted(fits)[:3]


def test_tree_leaves_out_most_of_clustered_rows():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(64, 16)) * 400
    q = np.floor(np.repeat(centres, 512, axis=0) + draw.normal(size=(64 * 512, 16)) * 10).astype(np.int64)
    labels = (np.arange(len(q)) % 2).astype(np.int32)
    order = negatives.packing(q, labels)
    tree = negatives.Tree(order.astype(np.int64), labels[order], q[order])
    own = np.arange(0, len(q), 500)
    n = len(own)
    x = negatives.Questions(own, labels[own], q[own].astype(float), np.arange(n), np.full(n, -(2**53)), np.full(n, 2**53), np.arange(n))
    tree.search(x, 5, True)
    assert tree.scored < n * len(q) / 10


# --- 12


def whole(rows):
    return [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]


def check_whitened(got, rows, components):
    """Against exact deviations and the covariance's definition."""
    x = np.array([v for _, v in rows], float)
    n = len(rows)
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    sums = [sum(v[j] for _, v in rows) for j in range(x.shape[1])]
    exact = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in rows}
    assert len(got) == n * components
    for r in got:
        assert (r.n, int(r.deviation)) == (n, exact[r.vec_id])
        assert abs(r.explained - values[r.component - 1] / covariance.trace()) < 1e-9
        assert r.identity_error < 1e-9
    made = np.zeros((n, components))
    place = {i: k for k, (i, _) in enumerate(rows)}
    for r in got:
        made[place[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(made.T @ made / n - np.eye(components)).max() < 1e-9
    return made, centred @ vectors / np.sqrt(values)


def test_whitening(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    got = QUERIES["op12_exact_whitening"](spark, sf_dir).collect()
    made, plain = check_whitened(got, whole(rows), 8)
    sign = np.sign((made * plain).sum(axis=0))
    assert np.abs(made * sign - plain).max() < 1e-6
    assert all(r.deviation == int(r.deviation_exact) for r in got)


def test_whitening_of_odd_tables(spark):
    rows = odd_vectors()
    df = frame(spark, rows, VECTORS).withColumns({"n": F.lit(1), "parts": F.lit("x"), "component": F.lit(0)})
    own = [(i, v) for i, v, _ in rows if v and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v)]
    named = [(k, v) for k, (_, v) in enumerate(own)]  # ids are NULL twice
    got = whitening.whitened(df.drop("label")).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in own for _ in range(6))
    numbered = frame(spark, [(k, v, 0) for k, v in named], VECTORS)
    check_whitened(whitening.whitened(numbered).collect(), whole(named), 6)


def test_whitening_of_equal_eigenvalues(spark):
    rows = [(2 * i + s, [float(j == i) * (1 - 2 * s) for j in range(12)]) for i in range(12) for s in range(2)]
    check_whitened(whitening.whitened(frame(spark, [(*r, 0) for r in rows], VECTORS)).collect(), whole(rows), 8)


def test_whitening_leaves_out_what_does_not_vary(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0, float(i % 2)]) for i in range(9)]
    got = whitening.whitened(frame(spark, [(*r, 0) for r in rows], VECTORS)).collect()
    assert {r.component for r in got} == {1, 2}
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]):
        assert whitening.whitened(frame(spark, [(*r, 0) for r in few], VECTORS)).collect() == []


def test_whitening_of_large_entries(spark):
    rows = [(i, [1e12 * (i % 3), 3e10 * i]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_whitened(whitening.whitened(df).collect(), whole(rows), 2)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=2, max_size=9))
def test_roots_and_null_spaces(rows):
    y = np.array(rows, object)
    m = y.T.dot(y)
    p = np.array(whitening.primes(40))
    found = whitening.polynomial_modulo(np.array([[[int(v) % int(q) for v in r] for r in m] for q in p]), p)
    plain = np.poly(np.array(m, float))[::-1]
    assert all((int(a) - round(b)) % int(q) == 0 for q, cs in zip(p, found, strict=True) for a, b in zip(cs, plain, strict=True))
    roots, places = whitening.largest_roots([round(c) for c in plain], 4)
    values = np.linalg.eigvalsh(np.array(m, float))[::-1]
    assert len(roots) == np.linalg.matrix_rank(np.array(m, float))
    assert np.allclose([r / 2**places for r in roots], values[: len(roots)], atol=1e-6)
    for value, v in whitening.components(m, roots, places) if roots else ():
        away = [sum(Decimal(int(a)) * x for a, x in zip(r, v, strict=True)) - value * y_ for r, y_ in zip(m, v, strict=True)]
        assert max(map(abs, away)) < Decimal("1e-12")


# --- 13

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def passages():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([3, 9, 10, 11, 25])))) for i in range(20)]
    items += [(30, None), (31, ""), (32, "?!"), (None, "null id here"), (3, "again under three"), (40, "a " * 15), (41, "É日 ñ0"), (20, items[5][1])]
    docs = [(i, " ".join(draw.choices(words, k=draw.randrange(0, 60)))) for i in range(40)]
    docs += [(100 + i, f"{docs[i][1]}, {(t or '').upper()}. {docs[i + 1][1]}") for i, (_, t) in enumerate(items)]
    docs += [(200 + i, " ".join(draw.sample((t or "").split(), len((t or "").split())))) for i, (_, t) in enumerate(items)]
    docs += [(300, None), (301, ""), (None, items[4][1]), (None, items[4][1]), (302, items[4][1]), (303, "a " * 300), (304, "x" * 100_000 + " " + items[7][1])]
    docs += [(305, "É日 ñ0"), (306, "é日 ñ0"), (307, "null\tid-here"), (308, " ".join(w for w in items[6][1].split()[:10])), (309, (items[6][1] + " ") * 500)]
    half = items[8][1].split()
    return docs + [(310, " ".join(half[:2])), (311, " ".join(half[2:]))], items  # a window across two documents is none


@pytest.mark.parametrize("block", [200_000, 40])
def test_passages(spark, monkeypatch, block):
    monkeypatch.setattr(postings, "BLOCK", block)
    docs, items = passages()
    df = frame(spark, docs, DOCS).withColumns({"segment": F.lit("x"), "items": F.lit(1), "item_id": F.lit(2)})
    asked = frame(spark, items, ITEMS).withColumns({"words": F.lit(1), "terms": F.lit(None).cast("string")})
    got = postings.decontaminated(df, asked).collect()
    assert same(got, brute.leaks(docs, items))
    assert any(r.n_near_items > r.n_items > 0 for r in got) and any(r.contaminated for r in got)


def test_passages_of_empty_tables(spark):
    docs, items = passages()
    assert postings.decontaminated(frame(spark, [], DOCS), frame(spark, items, ITEMS)).collect() == []
    got = postings.decontaminated(frame(spark, docs, DOCS), frame(spark, [], ITEMS)).collect()
    assert same(got, brute.leaks(docs, []))


def test_terms_of_one_hash_are_told_apart():
    one, two = np.array([5, 5, 7, 5], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    s = postings.segment(one, two, np.array([4]))
    assert s.counts.tolist() == [2, 1, 1] and s.positions.tolist() == [0, 3, 1, 2]
    assert s.places(np.array([5, 5, 7, 7, 9], np.uint64), np.array([2, 1, 1, 2, 1], np.uint64)).tolist() == [1, 0, 2, -1, -1]


def test_index_is_asked_again(spark):
    docs, items = passages()
    index = postings.build(frame(spark, docs, DOCS))
    one = postings.ask(index, frame(spark, items[:10], ITEMS), span=None).select("doc_id", F.size("items").alias("n")).collect()
    assert sum(r.n for r in one) == sum(r[3] for r in brute.leaks(docs, items[:10]))
    assert pa.Table is type(index.toArrow())
