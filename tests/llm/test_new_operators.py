"""Clustering, byte-level BPE and resampling against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lidarframe.llm import byte_bpe, clustering, resampling

SF = "/root/testdata/sf0.001"


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        folder = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        con.execute(f"CREATE VIEW {name} AS FROM '{folder}/*.parquet'")
    found = con.sql(sql)
    return found.columns, Counter(map(repr, found.fetchall()))


def rows_like(found, columns):
    return Counter(repr(tuple(r)) for r in found.select(columns).collect())


# clustering


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 12), st.sampled_from([1, 3, 200, 1 << 20]))
def test_nearest_like_all_distances(seed, centroids, components, spread):
    r = np.random.default_rng(seed)
    c = r.integers(-spread, spread + 1, (centroids, components))
    x = np.concatenate([r.integers(-spread, spread + 1, (50, components)), c])
    number, distance = clustering.Centroids(c).nearest(x)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (distance == d.min(1)).all() and (number == d.argmin(1)).all()  # argmin: the smaller number


def test_search_rejects_most_centroids():
    r = np.random.default_rng(0)
    centres = r.integers(-20, 20, (40, 1)) * 100 + r.integers(-50, 50, (40, 64))
    search = clustering.Centroids(centres)
    search.nearest(np.repeat(centres, 50, 0) + r.integers(-20, 20, (2000, 64)))
    assert search.visited < 2000 * 8


def test_clusters_like_sql(spark, stored):
    r = np.random.default_rng(4)
    rows = [(k, (r.normal(size=64) + k % 7).tolist(), "x") for k in range(300)]
    rows += [(1000 + k, rows[3][1], "x") for k in range(150)] + [(5, rows[5][1], "x")]
    rows += [(None, rows[0][1], "x"), (None, rows[1][1], None), (2000, None, None), (2001, [1.0] * 63, "x"), (2002, [], "x")]
    rows += [(2003, [float("nan")] + [0.0] * 63, "x"), (2004, [float("inf")] * 64, "x"), (2005, [None] + [0.0] * 63, "x"), (2006, [0.0] * 64, "x")]
    table = stored(rows, "vec_id long, embedding array<float>, cluster string")
    found = clustering.cluster(table)
    columns, want = by_sql(clustering.OP11_SQL, embeddings=table)
    assert rows_like(found, columns) == want and sum(want.values()) == 300 + 151 + 2 + 1


def test_clusters_of_few_rows_and_nothing(stored):
    table = stored([(7, [1.0] * 64), (8, [1.0] * 64), (9, [-0.001] * 64)], "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in clustering.cluster(table).collect()}
    assert {r.distance for r in found.values()} == {0} and found[7].cluster == found[8].cluster != found[9].cluster
    assert found[9].centroid_sha256 == hashlib.sha256(",".join(["-1"] * 64).encode()).hexdigest()
    assert clustering.cluster(table.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large"):
        clustering.cluster(stored([(1, [1e9] * 64)], "vec_id long, embedding array<float>")).collect()


def test_centroids_round_down(spark):
    kept = spark.createDataFrame([(1, [-1, 1]), (2, [-2, 2])], "vec_id long, v array<long>")
    assert clustering.improve(kept, np.array([[0, 0], [90, 90]])).tolist() == [[-2, 1], [90, 90]]


# byte-level BPE


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.vocabulary().ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_encodes_to_itself():
    assert byte_bpe.vocabulary().check()


PARTS = ["a", "b", " ", "  ", "\n", "\t ", "é", "中文", "'s", "'", "'l", "l", "1", "½", "!", "the", "aaaa", "　", "\U0001f600", "<|endoftext|>", "ß"]


@pytest.mark.parametrize("leaf", [1, 2, 5, 1 << 14])
def test_encoding_like_tiktoken(monkeypatch, tiktoken_encoding, leaf):
    monkeypatch.setattr(byte_bpe, "_LEAF", leaf)
    known = byte_bpe.Vocabulary()
    r = random.Random(leaf)
    for n in range(3000):
        text = "".join(r.choices(PARTS, k=r.randint(0, 30)))
        ids = known.encode(text)
        assert "".join(known.matches(text)) == text
        assert ids == tiktoken_encoding.encode_ordinary(text)
        assert known.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3001, "ab" * 2000, " " * 5000, "=-" * 1500, "abc" * 999 + "a", "é" * 700, "\n" * 900 + "x"])
def test_long_matches_like_tiktoken(tiktoken_encoding, text):
    assert byte_bpe.vocabulary().encode(text) == tiktoken_encoding.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=40))
def test_joins_are_encodings_of_the_whole(a, b):
    known = byte_bpe.vocabulary()
    assert known.join(known.merge(a), known.merge(b)) == known.merge(a + b) == known._merge_large(a + b)


def test_remembered_words_are_dropped_in_generations(monkeypatch, tiktoken_encoding):
    monkeypatch.setattr(byte_bpe, "_KNOWN", 10)
    known = byte_bpe.Vocabulary()
    for k in range(200):
        assert known.encode(f"always w{k}ord") == tiktoken_encoding.encode_ordinary(f"always w{k}ord")
    assert len(known.words) <= 10 and len(known.words.old) <= 10


def test_op12_like_tiktoken(spark, tiktoken_encoding):
    found = {r.doc_id: r for r in byte_bpe.op12_byte_bpe(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = tiktoken_encoding.encode_ordinary(r.text or "")
        got = found.pop(r.doc_id)
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert not found


def test_encode_and_decode_odd_rows(odd_docs, tiktoken_encoding):
    encoded = byte_bpe.encode(odd_docs.withColumnRenamed("source", "ids"))
    want = Counter((r.doc_id, tuple(tiktoken_encoding.encode_ordinary(r.text or ""))) for r in odd_docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    back = Counter((r.doc_id, bytes(r.data).decode()) for r in byte_bpe.decode(encoded).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in odd_docs.collect())
    digests = Counter((r.doc_id, r.n_tokens) for r in byte_bpe.digests(odd_docs).collect())
    assert digests == Counter((k, len(ids)) for k, ids in want.elements())
    assert byte_bpe.encode(odd_docs.limit(0)).count() == byte_bpe.digests(odd_docs.limit(0)).count() == 0


# importance resampling


def slow_buckets(text, longest, buckets):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
    return Counter(zlib.crc32(run.encode()) % buckets for run in runs)


@pytest.mark.parametrize("block", [8, 1 << 20])
@pytest.mark.parametrize("longest", [1, 2, 3])
def test_buckets_like_crc_of_runs(monkeypatch, block, longest):
    monkeypatch.setattr(resampling, "_BLOCK", block)
    r = random.Random(longest)
    parts = ["Ab", "é", "x9", " ", "  ", "_", "中文", ".", "\n", "a" * 70, "\x00", "ß", "Éa"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 60))) for _ in range(80)] + [None, "", " . "]
    words = [resampling.words_of(t.encode() if t else None) for t in texts]
    for text, (which, n) in zip(texts, resampling._features(words, longest, 997)):
        assert Counter(dict(zip(which.tolist(), n.tolist()))) == slow_buckets(text, longest, 997)


def test_scan_emits_every_word_once():
    words = [w.encode() for w in ["a", "ab", "a", "b", "aba", "é", "a", "a"]]
    (found,) = resampling.payloads([words])
    assert found.tolist() == [zlib.crc32(w) << 32 | len(w) for w in words]


def slow_resample(docs, target, longest, percent, least):
    s, t = Counter(), Counter()
    for text in docs.values():
        s += slow_buckets(text, longest, 10000)
    for text in target:
        t += slow_buckets(text, longest, 10000)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in s}
    rows = {}
    for k, text in docs.items():
        found = slow_buckets(text, longest, 10000)
        weight = sum(gain[b] * n for b, n in found.items())
        h = int(hashlib.sha256(f"2024:{k}".encode()).hexdigest()[:8], 16)
        rows[k] = [found.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None]
    able = [k for k, text in docs.items() if slow_buckets(text, 1, 10000).total() >= least]
    for place, k in enumerate(sorted(able, key=lambda k: (-rows[k][2], k))[: percent * len(able) // 100]):
        rows[k][3] = place + 1
    return rows


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_like_one_by_one(docs, longest):
    r = random.Random(5)
    names = [f"w{k}" for k in range(300)] + ["Éa", "x_y"]
    texts = {k: " ".join(r.choices(names, k=r.randint(0, 60))) for k in range(300)}
    target = [" ".join(r.choices(names[:40], k=30)) for _ in range(20)]
    found = resampling.resample(docs(list(texts.items())), docs(list(enumerate(target))), longest=longest).collect()
    got = {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in found}
    assert got == slow_resample(texts, target, longest, 10, 20)


def test_resampling_like_sql_on_odd_rows(docs, odd_docs):
    r = random.Random(6)
    rows = [(k % 150, " ".join(r.choices(["Aa", "b_c", "é", "zz"], k=40))) for k in range(200)]
    table = odd_docs.unionByName(docs(rows)).withColumnRenamed("source", "rank").withColumnRenamed("lang", "weight")
    path = odd_docs.inputFiles()[0].rsplit("/", 1)[0] + "-both"
    table.write.parquet(path)
    table = odd_docs.sparkSession.read.parquet(path)
    target = docs([(1, "aa aa zz"), (2, None), (2, "")])
    found = resampling.resample(table, target)
    columns, want = by_sql(resampling.OP13_SQL, documents=table, benchmark=target)
    assert rows_like(found, columns) == want
    assert resampling.resample(table.limit(0), target).count() == 0
    assert resampling.resample(table, target.limit(0)).count() == 210
