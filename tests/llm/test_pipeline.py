"""The pipeline's stages against plain Python on a small table, and the queries against their SQL."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from lidarframe.llm import mixing, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage over the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages] == ["toxicity", "simhash", "substrings", "mixing", "packing"]
    for _, before, after in stages[:-1]:
        assert before.dtypes == after.dtypes


def test_toxicity_stage(spark, stages):
    _, before, after = stages[0]
    model = toxicity.learn(before, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(before, model).collect() if r.score >= toxicity.THRESHOLD}
    assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in before.collect() if r.doc_id not in bad)


def test_simhash_stage(stages):
    _, before, after = stages[1]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    prints = [simhash.simhash((r.text or "").encode()) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    want = sorted(rows[k].doc_id for k in range(len(rows)) if find(k) == k)
    assert sorted(r.doc_id for r in after.collect()) == want


def test_substrings_stage(stages):
    _, before, after = stages[2]
    old = {r.doc_id: r.text for r in before.collect()}
    new = {r.doc_id: r for r in after.collect()}
    assert old.keys() == new.keys()
    assert all(len(r.text) <= len(old[k]) and r.n_chars == len(r.text) for k, r in new.items() if r.text is not None)


def test_mixing_stage(stages):
    _, before, after = stages[3]
    had, has = ({r.doc_id: r for r in t.collect()} for t in (before, after))
    assert had == has  # every document stays
    counts = Counter(r.doc_id for r in after.collect())
    assert max(counts.values()) <= mixing.MAX_REPEATS


def test_packing_stage(stages):
    _, before, after = stages[4]
    found = after.toPandas()
    assert (found.groupby("sequence_id").length.sum() <= 1024).all()
    assert (found.piece == 0).sum() == before.count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_like_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(want.fetchall())


def test_all_queries_are_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]
