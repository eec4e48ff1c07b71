"""Every query of the subpackage on whole tables, against its SQL or the brute force."""

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from plumbline.llm import mixing, ranker
from plumbline.llm.common import table
from plumbline.llm.fertility import vocabulary_path
from plumbline.llm.queries import ORACLE, QUERIES
from plumbline.llm.viterbi import SPACE, lattice

from . import brute

TABLES = "documents pages labels embeddings benchmark".split()


def key(row):
    return [(v is None, str(type(v)), str(v)) for v in row]


def same(mine, theirs):
    return sorted(map(tuple, mine), key=key) == sorted(map(tuple, theirs), key=key)


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(sql):
    return sql.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, sf_dir, sql, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = sql.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert same(df.select(*columns).collect(), cursor.fetchall())


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize(
    ("name", "columns", "plain"),
    [
        ("op1_ngram_jaccard", "doc_id n_shingles component_id", brute.near),
        ("op2_secret_ownership", "doc_id n_assign n_access n_hex base_sha256", brute.secrets),
        ("op4_grace_hash", "doc_id keep_id group_size kept text_sha256", brute.exact),
        ("op5_level_doubling", "doc_id n_words n_removed kept_sha256", brute.substrings),
    ],
)
def test_brute_force(spark, sf_dir, texts, name, columns, plain):
    assert same(QUERIES[name](spark, sf_dir).select(*columns.split()).collect(), plain(texts))


def test_fertility_base_columns(spark, sf_dir, texts):
    rows = QUERIES["op3_fertility_rules"](spark, sf_dir).collect()
    mine = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert same(mine, [(i, *brute.quality(t)) for i, t in texts])
    assert not any(r.kept for r in rows if r.base_failed)


def test_ranking_on_held_out_rows(spark, sf_dir, sql):
    rows = QUERIES["op7_pairwise_ranking"](spark, sf_dir).collect()
    assert len(rows) == sql.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    known = dict(sql.execute("SELECT doc_id, quality FROM labels").fetchall())
    pairs = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([a == b for a, b in pairs]) > 0.9


def test_resharding(spark, sf_dir, texts):
    rows = QUERIES["op8_min_cost_resharding"](spark, sf_dir).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in texts}
    crc = {i: zlib.crc32((t or "").encode()) for i, t in texts}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {i: (size[i], crc[i]) for i in size}
    total, most = sum(size.values()), max(size.values())
    for shard in range(8):
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= 4 * most
    # no plan moves fewer bytes than the surplus of the old shards over their new capacity
    old = {s: sum(r["size"] for r in rows if r.old_shard == s) for s in range(10)}
    least = sum(max(0, n - total / 8) if s < 8 else n for s, n in old.items())
    moved = sum(r["size"] for r in rows if r.shard != r.old_shard)
    assert moved <= least + 16 * most


def test_viterbi(spark, sf_dir, texts):
    own = lattice(vocabulary_path())
    rows = {r.doc_id: r for r in QUERIES["op9_streaming_viterbi"](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    for i, text in texts:
        assert rows[i].exact
        if text and SPACE not in text and len(text) < 3000:
            assert rows[i].ids == brute.viterbi(own, SPACE + text.replace(" ", SPACE))


def test_pipeline(spark, sf_dir):
    """Against the stages the plain way: features and weights by numpy, groups by all pairs, the mix by rounds."""
    docs = table(spark, sf_dir, "documents").collect()
    model = ranker.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    x = ranker.features(pa.array([d.text for d in docs]))
    z = np.clip((x - np.array(model.mean)) / np.array(model.scale), -5, 5)
    docs = [d for d, raw in zip(docs, z @ np.array(model.weight), strict=True) if raw >= model.threshold - 1e-9]
    docs = [d for d, (*_, kept, _) in zip(docs, brute.exact([(d.doc_id, d.text) for d in docs]), strict=True) if kept]
    least = brute.near([(d.doc_id, d.text) for d in docs])
    docs = [d for d, (i, _, c) in zip(docs, least, strict=True) if i == c]
    size = {d.doc_id: len(brute.WORD.findall(d.text or "")) for d in docs}
    sources = sorted({d.source for d in docs})
    sums = {s: sum(size[d.doc_id] for d in docs if d.source == s) for s in sources}
    goal = brute.targets(sums, {s: i % 3 + 1 for i, s in enumerate(sources)})
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert all(r.exact for r in rows)
    own = lattice(vocabulary_path())
    taken = {s: 0 for s in sources}
    source = {d.doc_id: d.source for d in docs}
    times = {}
    for r in rows:
        taken[source[r.doc_id]] += len(brute.WORD.findall(own.decode(r.ids)))
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    largest = {s: max(size[d.doc_id] for d in docs if d.source == s) for s in sources}
    assert all(abs(taken[s] - goal[s]) <= 1 + largest[s] for s in sources)  # texts stay whole
    whole = {s: int(round(goal[s]) // sums[s]) for s in sources}
    assert all(times.get(d.doc_id, 0) - whole[d.source] in (0, 1) for d in docs)
    whole_ids = {tuple(brute.viterbi(own, SPACE + d.text.replace(" ", SPACE))) for d in docs if d.text and len(d.text) < 2000}
    mine = {tuple(r.ids) for r in rows}
    assert len(whole_ids - mine) <= sum(times.get(d.doc_id, 0) == 0 for d in docs)


def test_mix_draws_by_seed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    one, two = (mixing.mix_sources(docs, seed="x").collect() for _ in range(2))
    assert same(one, two)
    assert not same(one, mixing.mix_sources(docs, seed=f"y{random.random()}").collect())


def test_levels_double_to_the_end(spark, sf_dir):
    found = {r.longest for r in QUERIES["op5_level_doubling"](spark, sf_dir).select("longest").distinct().collect()}
    assert {13, 26, 52} <= found
