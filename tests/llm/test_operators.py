"""Operators against brute force on small tables, and on odd rows."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lidarframe.llm import (
    common,
    language,
    mixing,
    packing,
    product_quantisation,
    quality,
    sharding,
    simhash,
    substrings,
    toxicity,
    warc,
)
from lidarframe.llm.components import connected_components

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n)) + "."


HELPERS = (
    "row __row bucket __bucket size __size n k before to group first id rank row_file row_at places spans __source __tokens "
    "__places __name __group __id c0 c1 c7 digest component_id fp key a b toxic hits weight words copy phrase vec cid member "
    "record_id kind number chunk length start text2"
).split()


@pytest.mark.parametrize("extra", [HELPERS, ["_metadata"]])
@pytest.mark.parametrize(
    "operator",
    [
        lambda d: sharding.shard(d, 3),
        simhash.drop_near_duplicates,
        substrings.remove_repeats,
        mixing.mix,
        lambda d: toxicity.drop_toxic(d, toxicity.Model({"long9": 2.0}, (), (-30.0, 1.0, 1.0))),
        lambda d: corpus_pipeline.one_of_near_copies(d.sparkSession, d, None),
        lambda d: corpus_pipeline.cut_repeats(d.sparkSession, d, None),
        lambda d: corpus_pipeline.mix_sources(d.sparkSession, d, None),
    ],
)
def test_clashing_names(odd_docs, stored, operator, extra):
    """Extra columns of any name come out as they went in, on the rows they belong to."""
    rows = [(*r, *[f"{r.doc_id} {k}" for k in range(len(extra))]) for r in odd_docs.collect()]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in odd_docs.schema] + [f"`{n}` string" for n in extra])
    table = stored(rows, schema)
    plain, found = operator(odd_docs), operator(table)
    assert [c for c in found.columns if c not in extra] == plain.columns
    assert set(extra) <= set(found.columns)
    assert Counter(r.doc_id for r in found.collect()) == Counter(r.doc_id for r in plain.collect())
    for r in found.collect():
        assert [r[n] for n in extra] == [f"{r.doc_id} {k}" for k in range(len(extra))]


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: toxicity.score(d, toxicity.Model({"long9": 2.0}, (), (-3.0, 1.0, 1.0))),
        lambda d: language.predict(d, language.Field(["a"], np.zeros((language.TABLE, 1)), np.zeros((1, 1))), with_shares=False),
        lambda d: packing.pack(d).select("doc_id", "piece", "start", "length", "ids_crc32"),
        quality.ledger,
        simhash.near_duplicates,
    ],
)
def test_clashing_names_that_are_not_read(odd_docs, operator):
    table = odd_docs.withColumns({n: F.lit(n) for n in HELPERS})
    assert Counter(map(tuple, operator(table).collect())) == Counter(map(tuple, operator(odd_docs).collect()))


def groups(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(k) for k in range(n)]


# sharding


def test_shards_are_level_gapless_and_shuffled(odd_docs, docs):
    many = docs([(k, prose(k % 5)) for k in range(500)])
    for table, size in ((odd_docs, 3), (many, 40)):
        rows = sharding.shard(table, size, "coalesce(octet_length(text), 0) + 16", bucket_bytes=5000).toPandas()
        assert len(rows) == table.count()
        counts = rows.groupby("shard").size().reindex(range(size), fill_value=0)
        assert counts.max() - counts.min() <= 1
        for _, slots in rows.groupby("shard").slot:
            assert sorted(slots) == list(range(len(slots)))
    order = rows.sort_values(["slot", "shard"]).doc_id.to_numpy()
    assert (np.diff(order) == 1).mean() < 0.02


def test_shards_of_nothing_and_clashing_names(docs, spark):
    assert sharding.shard(docs([(1, "a")]).limit(0)).count() == 0
    rows = spark.createDataFrame([(1, 9, 9)], "doc_id long, Shard int, slot long").coalesce(1)
    assert sharding.shard(rows, 1).columns == ["doc_id", "shard", "slot"]


def test_buckets_are_numbered_in_groups(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_GROUP", 3)
    rows = sharding.shard(docs([(k, prose(k)) for k in range(200)]), 7, "100", bucket_bytes=900).toPandas()
    counts = rows.groupby("shard").size()
    assert len(rows) == 200 and counts.max() - counts.min() <= 1
    assert all(sorted(slots) == list(range(len(slots))) for _, slots in rows.groupby("shard").slot)


def test_write_shards(docs, spark, tmp_path):
    rows = sharding.shard(docs([(k, prose(k)) for k in range(90)]), 3)
    sharding.write_shards(rows, str(tmp_path / "shards"), rows_per_file=10)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 90 and back.select("doc_id").distinct().count() == 90


def test_op1_writes_whole_documents(spark, monkeypatch):
    paths = []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda rows, path: (paths.append(path), write(rows, path)))
    found = {r.doc_id: r for r in sharding.op1_sharding(spark, SF).collect()}
    had = spark.read.parquet(f"{SF}/documents.parquet")
    (path,) = paths
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(had.columns).collect())) == Counter(map(tuple, had.collect()))
    for r in back.collect():
        text = (r.text or "").encode()
        assert (found[r.doc_id].size, found[r.doc_id].text_crc32) == (len(text) + 16, zlib.crc32(text))
        assert (found[r.doc_id].shard, found[r.doc_id].slot) == (r.shard, r.slot)


# components and SimHash


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, pairs):
    found = connected_components(spark.createDataFrame(pairs, "src long, dst long"))
    root = groups(31, pairs)
    least = {}
    for k in range(31):
        least.setdefault(root[k], k)
    want = {k: least[root[k]] for pair in pairs for k in pair}
    assert {r.node: r.component for r in found.collect()} == want


def slow_simhash(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_docs):
    found = Counter((r.doc_id, r.fp % 2**64) for r in simhash.fingerprints(odd_docs).collect())
    assert found == Counter((r.doc_id, slow_simhash(r.text)) for r in odd_docs.collect())


@pytest.mark.parametrize("hot_bucket", [4, simhash.HOT_BUCKET])
def test_fingerprint_links_lose_nothing(spark, hot_bucket):
    r = random.Random(3)
    values = {0, 2**64 - 1, 1, 3, 7, 15}
    for _ in range(40):
        centre = r.getrandbits(64)
        for _ in range(12):
            values.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))))
    values = sorted(values)
    table = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    found = connected_components(simhash.fingerprint_links(table, hot_bucket))
    at = {v: k for k, v in enumerate(values)}
    pairs = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3]
    root = groups(len(values), pairs)
    got = groups(len(values), [(at[x.node % 2**64], at[x.component % 2**64]) for x in found.collect()])
    as_sets = lambda g: {frozenset(k for k in range(len(g)) if g[k] == x) for x in g}
    assert as_sets(root) == as_sets(got)


def test_near_duplicates_and_drop(odd_docs, docs):
    base = [prose(k, 300) for k in range(6)]
    near = [t.replace("alpha", "alphax", 1) for t in base]
    table = docs([(k, t) for k, t in enumerate(base + near + base)])
    rows = table.collect()
    prints = [slow_simhash(r.text) for r in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = groups(len(rows), pairs)
    least = defaultdict(list)
    for k, r in enumerate(rows):
        least[root[k]].append(r.doc_id)
    want = {r.doc_id: min(least[root[k]]) for k, r in enumerate(rows)}
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()} == want
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(table).collect()) == sorted(set(want.values()))

    odd = simhash.near_duplicates(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert {r.component_id for r in odd if r.fp == 0} == {1}
    kept = Counter(r.doc_id for r in simhash.drop_near_duplicates(odd_docs).collect())
    assert kept == Counter([None, 1, 4, 5, 7])
    assert simhash.drop_near_duplicates(odd_docs.limit(0)).count() == 0


# vectors


def test_vectors_like_sql(spark, stored, tmp_path):
    r = np.random.default_rng(1)
    rows = []
    for k in range(60):
        centre = r.normal(size=10)
        for _ in range(r.integers(1, 5)):
            rows.append((len(rows), (centre + r.normal(size=10) * 0.08).astype(np.float32).tolist(), int(k % 3)))
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(20)]
    rows += [
        (2000, None, 1),
        (2001, [0.0] * 10, 1),
        (2002, [float("nan")] * 10, 1),
        (2003, rows[0][1], None),
        (2004, [None] + rows[0][1][1:], 0),
        (2005, [], 0),
        (2006, rows[0][1][:4], 0),
        (2007, [float("inf")] * 10, 0),
    ]
    table = stored(rows, "vec_id long, embedding array<float>, label int")
    got = product_quantisation.near_duplicate_vectors(table, sample=100, tile=16).toPandas().sort_values("vec_id")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{table.inputFiles()[0].rsplit('/', 1)[0].removeprefix('file:')}/*.parquet'")
    want = con.execute(product_quantisation.OP2_SQL).df().sort_values("vec_id")
    assert got.values.tolist() == want[got.columns].values.tolist()
    assert got.n_links.sum() > 500


def test_vectors_null_ids_and_nothing(stored):
    table = stored([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.01], 1)], "vec_id long, embedding array<float>, label int")
    found = product_quantisation.near_duplicate_vectors(table).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in found) == [(0, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True)]
    assert product_quantisation.near_duplicate_vectors(table.limit(0)).count() == 0


# toxicity


def toxic_rows(n=400):
    rows, labels = [], []
    for k in range(n):
        text = prose(k, 80)
        bad = k % 8 == 0
        if bad:
            text = text.replace(" ", " fiend ", 2).replace(" ", " rotter ", 1)
        rows.append((k, text))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_learns_and_folds(docs, spark):
    rows, labels = toxic_rows()
    model = toxicity.learn(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(model.terms) == {"fiend", "rotter"}
    probe = docs([(1, prose(900) + " f1ẹnd"), (2, prose(901)), (3, "fiendish"), (4, None), (5, ""), (None, "Rоttеr!"), (5, "")])
    found = toxicity.score(probe, model).collect()
    assert sorted((r.doc_id or 0, r.hits) for r in found) == [(0, 1), (1, 1), (2, 0), (3, 0), (4, 0), (5, 0), (5, 0)]
    assert all((r.score >= toxicity.THRESHOLD) == (r.hits > 0) for r in found)
    kept = toxicity.drop_toxic(probe, model)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 5] and kept.columns == probe.columns


def test_toxicity_exceptions():
    m = toxicity.Matcher({"clown": 2.0}, ("clown fish", "class clown"))
    assert [h[:2] for h in m.hits("a clown and a clown fish, a class clown; clown")] == [(2, 7), (41, 46)]
    assert toxicity.fold("Ｉｄ１оt​") == "idiot"


def slow_hits(terms, phrases, text):
    def places(what):
        for k in range(len(text) - len(what) + 1):
            if text.startswith(what, k):
                around = text[max(0, k - 1) : k], text[k + len(what) : k + len(what) + 1]
                if not any(c.isalpha() for c in around):
                    yield k, k + len(what)

    covers = [p for phrase in phrases if phrase not in terms for p in places(phrase)]
    return sorted(
        (a, b, w) for t, w in terms.items() for a, b in places(t) if not any(s <= a and b <= e for s, e in covers)
    )


@settings(max_examples=300, deadline=None)
@given(
    st.dictionaries(st.sampled_from(["a", "b", "ab", "b a", "c", "a b c"]), st.floats(0.1, 3), max_size=4),
    st.lists(st.sampled_from(["a b", "b a b", "b b", "a", "c c c c", "a b a b a", "b c"]), max_size=5),
    st.lists(st.sampled_from(["a", "b", "ab", "c", "1"]), max_size=40).map(" ".join),
)
def test_matcher_like_plain_scan(terms, phrases, text):
    assert sorted(toxicity.Matcher(terms, tuple(phrases)).hits(text)) == slow_hits(terms, phrases, text)


def test_long_exception_behind_many_short_ones():
    short = [f"b{c}" for c in "cdefghijk"]
    text = "z " + " ".join(short) + " clown fish"
    m = toxicity.Matcher({"z": 1.0, "clown": 2.0}, (*short, text))
    assert m.hits(text) == []


def test_every_significant_word_is_learned(docs, spark):
    words = [f"{'x' * (30 + k)}bad{WORDS[k % 17]}{WORDS[k // 17]}" for k in range(40)]
    rows = [(k, prose(k, 30) + (" " + " ".join(words) if k % 8 == 0 else "")) for k in range(400)]
    rows += [(0, rows[0][1])] * 50  # a repeated row teaches once
    labels = [(k, int(k % 8 == 0)) for k in range(400)]
    model = toxicity.learn(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(words) <= set(model.terms)


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in toxicity.op3_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    bad = [r for r in found if labels[r.doc_id]]
    assert sum(r.predicted for r in bad) >= 0.6 * len(bad)
    assert sum(r.predicted for r in found) - sum(r.predicted for r in bad) <= 0.01 * len(found)


def test_toxicity_without_labels(docs, spark):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs([(1, "a b c")]), none)
    assert toxicity.score(docs([(1, "a")]), model).first().score < 0.01
    assert toxicity.score(docs([(1, "a")]).limit(0), model).count() == 0


# language


def test_forward_backward_like_all_paths():
    r = np.random.default_rng(0)
    e, t = r.normal(size=(1, 4, 3)), r.normal(size=(3, 3))
    gamma, pairs = language.forward_backward(e, t)
    want, total = np.zeros((4, 3)), 0.0
    for path in np.ndindex(3, 3, 3, 3):
        p = np.exp(sum(e[0, k, s] for k, s in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        total += p
        for k, s in enumerate(path):
            want[k, s] += p
    assert np.allclose(gamma[0], want / total) and np.isclose(pairs.sum(), 3)


def test_labeller_like_forward_backward():
    r = np.random.default_rng(0)
    field = language.Field(["a", "b"], r.normal(size=(language.TABLE, 2)), r.normal(size=(2, 2)))
    texts = [["one", "two", "three"], [], ["x"], ["w"] * (language.BLOCK + 5)]
    got = language.Labeller(field).sums(texts)
    for words, sums in zip(texts, got):
        want = np.zeros(2)
        for k in range(0, len(words), language.BLOCK):
            block = words[k : k + language.BLOCK]
            e = language.emissions(field.weights, block)
            want += language.forward_backward(e[None], field.transitions)[0][0].sum(0)
        assert np.allclose(sums, want)


def test_language_accuracy_and_odd_rows(spark, odd_docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    held = {r.doc_id: r.lang for r in table.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    found = {r.doc_id: r for r in language.op4_language(spark, SF).collect()}
    assert all(found[k].held_out for k in held)
    assert np.mean([found[k].lang_pred == v for k, v in held.items()]) > 0.95
    field = language.learn(table)
    odd = language.predict(odd_docs, field).collect()
    assert len(odd) == 10 and all(r.lang_pred == "und" and r.score == 0 for r in odd if r.doc_id in (1, 2, 3))
    assert language.predict(odd_docs, language.learn(odd_docs.limit(0))).first().lang_pred == "und"


def test_numbers_are_no_letters(docs):
    field = language.fit_field([("de", "eins zwei drei vier".split()), ("en", "one two three four".split())])
    rows = [(1, "½ ²"), (2, "Ⅻ"), (3, "①② ٣"), (4, "½zwei²drei"), (5, "_ 12")]
    found = {r.doc_id: r for r in language.predict(docs(rows), field).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3, 5)] == ["und"] * 4 and found[4].words == 2
    assert language.words_of("x½é²中_7Ⅻz") == ["x", "é", "中", "z"]


def test_features_are_those_of_each_word():
    words = ["a", "ab", "abcab", "é", "x" * 24, "a", "中文"]
    flat, owner = language.features(words)
    assert (np.diff(owner) >= 0).all() and (flat < language.TABLE).all() and (flat >= 0).all()
    for k, w in enumerate(words):
        one, _ = language.features([w])
        n = len(w)
        assert Counter(one.tolist()) == Counter(flat[owner == k].tolist())
        grams = n + max(0, n - 1) + max(0, n - 2)
        assert len(one) == grams + min(n, 3) + min(n, 4) + 1


def test_too_many_languages_are_an_error(docs, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        language.learn(docs([(k, "a b", f"l{k}") for k in range(3)]))


def test_every_language_is_learned(docs):
    names = [f"l{k:02d}" for k in range(70)]
    rows = [(100 * k + d, f"{name}word {name}thing", name) for k, name in enumerate(names) for d in range(3 if k < 69 else 1)]
    rows += [(1, "l00word l00thing", "l00")] * 300
    assert language.learn(docs(rows)).labels == names


def test_repeated_rows_teach_once(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit_field", lambda texts: seen.extend(texts))
    rows = [(1, "one text again", "a")] * 50 + [(k, f"other text {k * 'x'}", "a") for k in range(2, 6)]
    language.learn(docs(rows + [(9, "noch eins", "b")]), per_language=5)
    assert Counter(name for name, _ in seen) == {"a": 5, "b": 1}
    assert len({tuple(words) for _, words in seen}) == 6


def test_text_without_blanks_is_read_whole(docs):
    rng = random.Random(3)
    run = "".join(rng.choices("abcdefgh", k=1000))
    assert "".join(language.words_of(run)) == run and max(map(len, language.words_of(run))) <= 24
    assert language.words_of("ab 一二三四五x") == ["ab", "一二三四", "五", "x"]

    def unspaced(letters, n):
        return "".join(rng.choices(letters, k=n))

    first, second, edge = "一二三四五六七八", "東西南北春夏秋冬", "山" * 12
    texts = [("en", prose(k).split()) for k in range(20)]
    texts += [("zh", language.words_of(unspaced(first, 200))) for _ in range(20)]
    texts += [("ja", language.words_of(unspaced(second, 200))) for _ in range(20)]
    field = language.fit_field(texts)
    rows = [
        (1, edge + unspaced(first, 300) + edge),  # the ends say nothing
        (2, edge + unspaced(second, 300) + edge),
        (3, unspaced(first, 60) + " " + prose(50, 8)),  # one run against eight short words
    ]
    assert {r.doc_id: r.lang_pred for r in language.predict(docs(rows), field).collect()} == {1: "zh", 2: "ja", 3: "zh"}


# packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=30))
def test_plan_uses_everything_once(counts):
    patterns = packing.plan(counts, 50)
    used = Counter()
    for lengths, times in patterns:
        assert sum(lengths) <= 50 and times > 0
        for n in lengths:
            used[n] += times
    assert used == Counter(counts)
    least = max(sum(k * n for k, n in counts.items()) / 50, sum(n for k, n in counts.items() if k > 25))
    assert sum(p.times for p in patterns) <= 1.5 * least + 1


def test_exact_complements_come_first():
    assert packing.plan({60: 3, 40: 5, 20: 4}, 100)[0] == ([60, 40], 3)
    assert ([40, 40, 20], 1) in packing.plan({60: 3, 40: 5, 20: 4}, 100)
    assert packing.plan({}, 10) == [] and packing.plan({1: 25}, 10)[0] == ([1] * 10, 2)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 29), st.integers(1, 3), max_size=12), st.integers(1, 29))
def test_complements_like_all_combinations(counts, gap):
    left = np.zeros(31, np.int64)
    for length, n in counts.items():
        left[length] = n
    pieces = sorted(n for length, k in counts.items() for n in [length] * k)
    for taken in [[], *[[n] for n in counts]]:
        rest = list(pieces)
        for n in taken:
            rest.remove(n)
        want = {c for n in (1, 2, 3) for c in combinations(rest, n) if sum(c) == gap}
        found = packing.Complements(left).find(gap, taken)
        assert (found is None) == (not want)
        if found:
            assert tuple(sorted(found)) in want and len(found) == min(map(len, want))


def test_words_are_remembered_in_generations(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 5)
    monkeypatch.setattr(packing, "_GROUP", 20)
    encode = packing.Encoder()
    calls = []
    inner = encode._encode
    encode._encode = lambda texts: (calls.extend(texts), inner(texts))[1]
    plain = packing.Encoder()
    for k in range(40):
        text = f"again w{k}x"
        assert encode(text) == plain._encode([text])[0]
    assert calls.count("again") == 1 and len(encode.young) <= 5 + 4


def test_words_stay_remembered_among_many(monkeypatch):
    """A vocabulary of half a million words is encoded once; long words are remembered by their size."""
    encode = packing.Encoder()
    joined = encode._encode_joined
    few = [" again", " wörd", " x"]
    assert joined(few) == encode._encode(few)
    calls = []
    encode._encode_joined = lambda words: (calls.extend(words), [b"\0\0\0\0"] * len(words))[1]
    numbers = [" " + "".join(chr(97 + int(d)) for d in str(n)) for n in range(450_000)]
    for start in (*range(0, 450_000, 90_000), 0):
        encode._add([(0, "".join(numbers[start : start + 90_000]))], [[]])
    assert len(calls) == 450_000
    monkeypatch.setattr(packing, "_HELD", 1000)
    for k in range(40):
        encode("".join(chr(97 + k % 26) for _ in range(600)) + str(k))
    assert sum(map(len, encode.young)) <= 3000 and sum(map(len, encode.old)) <= 4_000


@pytest.mark.parametrize("size", [5, 40, 1 << 16])
def test_blocks_give_the_ids_of_whole_texts(monkeypatch, size):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(packing, "_BLOCK", size)
    monkeypatch.setattr(packing, "_GROUP", 4 * size)
    random.seed(size)
    parts = ["word", "It's", " ", "  ", "\n", "\n\n", "é", "中文", "12", ".", ",", "<|endoftext|>", " \n", "\t", "!?", "x"]
    texts = ["".join(random.choices(parts, k=n)) for n in range(120)]
    for text, ids in zip(texts, packing.Encoder().many(texts)):
        assert "".join(packing.blocks(text)) == text
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_like_whole_texts(odd_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in odd_docs.collect()]
    extra = ["It's 3 x <|endoftext|>  \n\n naïve £5 中文 \U0001f600!!", "don't  stop\n"]
    encode = packing.encoder()
    for text in [t for t in texts if t] + extra:
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    found = packing.pack(odd_docs).toPandas()
    totals = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    starts = found[found.piece == 0]
    assert len(starts) == len(texts) and found.length.sum() == sum(totals)
    for _, s in found.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 1024
    long = found[found.doc_id == 4].sort_values("piece")
    assert list(long.start) == [0, *np.cumsum(long.length)[:-1]] and (long.length[1:] == 1024).all()
    assert packing.pack(odd_docs.limit(0)).count() == 0


# repeated passages


def slow_repeats(rows, min_line_words):
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: r[0]):
        repeated = set()
        for k, (a, b, n) in enumerate(substrings.units(text)):
            if n >= substrings.SHORT_UNIT:
                d = substrings.digest(text[a:b])
                if d in seen:
                    repeated.add(k)
                seen.add(d)
        out.append(substrings.cut(text, substrings.removed_spans(text, repeated, min_line_words=min_line_words)))
    return out


def test_repeats_like_one_by_one(docs):
    passage = ". ".join(prose(k, 15)[:-1].capitalize() for k in range(5)) + "."
    rows = [(k, f"{prose(100 + k, 20)} {passage} {prose(200 + k, 20)}\n{prose(7, 12)}\nEnd {k}.") for k in range(6)]
    found = {r.doc_id: r for r in substrings.remove_repeats(docs(rows), min_line_words=8).collect()}
    assert [found[k].text for k in range(6)] == slow_repeats(rows, 8)
    assert found[0].text == rows[0][1] and not found[0].removed_spans
    for k in range(1, 6):
        spans = [(s.start, s.end) for s in found[k].removed_spans]
        assert found[k].text == substrings.cut(rows[k][1], spans)
        assert passage[-200:] not in found[k].text and f"End {k}." in found[k].text and prose(7, 12) not in found[k].text


def test_short_lines_stay_unless_asked_for(docs):
    line, long_line = prose(7, 12), prose(8, 21)
    rows = [(k, f"{prose(100 + k, 20)}\n{line}\n{prose(200 + k, 20)}\n{long_line}\nEnd {k}.") for k in range(3)]
    found = {r.doc_id: r.text for r in substrings.remove_repeats(docs(rows)).collect()}
    assert all(line in found[k] and long_line not in found[k] and f"End {k}." in found[k] for k in (1, 2))
    found = {r.doc_id: r.text for r in substrings.remove_repeats(docs(rows), min_line_words=8).collect()}
    assert all(line not in found[k] and long_line not in found[k] for k in (1, 2))


@pytest.mark.parametrize("words", [51, 60])
def test_repeats_without_sentence_ends(docs, words):
    rng = random.Random(words)

    def some(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n)]

    rows, passages = [], []
    for k in range(60):
        passage = some(words)
        passages.append(" ".join(passage))
        for side in range(2):
            rows.append((2 * k + side, " ".join([*some(20 + k % 9), *passage, *some(20 + k % 7)])))
    found = {r.doc_id: r for r in substrings.remove_repeats(docs(rows)).collect()}
    for k, passage in enumerate(passages):
        assert found[2 * k].text == rows[2 * k][1]
        (span,) = found[2 * k + 1].removed_spans
        gone = rows[2 * k + 1][1][span.start : span.end].strip()
        assert gone in passage and len(gone.split()) >= substrings.MIN_WORDS


def test_repeats_of_sentences_glued_at_both_ends(docs):
    a, b, c = (prose(k, n).strip(".") for k, n in ((1, 18), (2, 17), (3, 18)))
    rows = [(k, f"{prose(50 + k, 9).strip('.')} {a}. {b}. {c} {prose(60 + k, 9)}") for k in range(2)]
    assert b not in {r.doc_id: r.text for r in substrings.remove_repeats(docs(rows)).collect()}[1]


def scattered(spark, tmp_path, name, rows, schema):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).repartition(6).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_splits(spark):
    """Splits of files that depend on the parallelism, which the returned function changes."""
    keys = "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set(keys[0], "4096")
    spark.conf.set(keys[1], "1")
    yield lambda n: spark.conf.set(keys[1], str(n))
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("table", ["files", "filtered", "other"])
def test_repeats_whatever_the_parallelism(spark, tmp_path, monkeypatch, small_splits, table):
    passage = ". ".join(prose(k, 15)[:-1] for k in range(4)) + "."
    rows = [(k % 300, f"{prose(1000 + k, 20)} {passage if k % 2 else ''} {prose(3000 + k % 500, 30)}") for k in range(600)]
    docs = scattered(spark, tmp_path, "docs", rows, "doc_id long, text string")
    splits = lambda: spark.read.parquet(str(tmp_path / "docs")).rdd.getNumPartitions()
    docs = {"files": docs, "filtered": docs.where("doc_id >= 0").select("text", "doc_id"), "other": docs.distinct()}[table]
    want = Counter((r.doc_id, r.text) for r in substrings.remove_repeats(docs).collect())
    write, parts = substrings.materialise, []

    def other_cores(df, name, *how):
        found = write(df, name, *how)
        parts.append(splits())
        small_splits(16)
        parts.append(splits())
        return found

    monkeypatch.setattr(substrings, "materialise", other_cores)
    got = Counter((r.doc_id, r.text) for r in substrings.remove_repeats(docs).collect())
    assert got == want and parts[0] != parts[1]


def test_archives_whatever_the_parallelism(spark, tmp_path, small_splits):
    rows = [(k % 200, f"http://a/{k}", "<p>" + prose(k % 50, 300)) for k in range(400)]
    pages = scattered(spark, tmp_path, "pages", rows, "page_id long, url string, html string")
    found = []
    for cores in (1, 16):
        small_splits(cores)
        again = common.with_row_keys(spark.read.parquet(str(tmp_path / "pages")), F.col("url").alias("u"))
        parts = again.rdd.getNumPartitions()
        found.append((parts, {(r.row_file, r.row_at): r.u for r in again.collect()}))
    assert found[0][0] != found[1][0] and found[0][1] == found[1][1] and len(found[0][1]) == 400
    warc.write_warc(pages, str(tmp_path / "warc"))
    captures = warc.assemble(warc.read_records(spark, str(tmp_path / "warc"))).collect()
    assert Counter(c.target_uri for c in captures) == Counter(r[1] for r in rows)


def test_repeats_odd_rows(odd_docs):
    found = substrings.remove_repeats(odd_docs).collect()
    assert len(found) == 10 and substrings.remove_repeats(odd_docs.limit(0)).count() == 0
    same = {r.doc_id: r.text for r in found}
    assert same[1] is None and same[2] == "" and same[4].count("\n") == 3999
    clean = [r for r in found if r.doc_id == 5]
    assert [r.text for r in clean] == ["same text twice in rows"] * 2  # too short to be a passage


# archives


def test_archives_like_sql(stored, spark, tmp_path):
    big = "<p>" + "é" * 800
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "u", None), (5, "u", ""), (6, "u", "x"), (7, "u", "x")]
    rows += [(None, "u", big), (8, "bad\r\nurl", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + big), (9, "v", big + "!"), (9, "v", big + "!")]
    pages = stored(rows, "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "warc"))
    captures = warc.assemble(warc.read_records(spark, str(tmp_path / "warc"))).collect()
    assert len(captures) == len(rows) and all(c.request.id and c.metadata.id for c in captures)
    payloads = Counter(bytes(c.payload).decode() for c in captures if c.record_type == "response")
    assert payloads == Counter({big: 1, "": 2, "x": 2, rows[8][2]: 1, big + "!": 1})
    ids = {c.record_id: bytes(c.metadata.payload).decode().strip() for c in captures}
    assert sorted(ids[c.refers_to] for c in captures if c.refers_to) == ["page-id: 3"] * 3 + ["page-id: 9"]
    assert {c.target_uri for c in captures} >= {None, "bad%0D%0Aurl"}


def test_archives_are_bounded_by_bytes(stored, spark, tmp_path, monkeypatch):
    from pathlib import Path

    monkeypatch.setattr(warc, "ARCHIVES", ((1000, 5), (20_000, 2), (None, 1)))
    rows = [(k, f"u{k}", prose(k, 4000) if k % 10 == 0 else prose(k, 300) if k % 3 == 0 else "x") for k in range(40)]
    pages = stored(rows, "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "warc"))
    most = Counter()
    for file in Path(tmp_path / "warc").rglob("*.gz"):
        sizes = [len(b) for h, b in warc.parse(file.read_bytes()) if h["warc-type"] == "response"]
        most[file.parent.name] = max(most[file.parent.name], len(sizes))
        assert len({(n > 1200) + (n > 20_200) for n in sizes}) == 1
    assert most == {"payloads-from-0": 5, "payloads-from-1000": 2, "payloads-from-20000": 1}
    captures = warc.assemble(warc.read_records(spark, str(tmp_path / "warc"))).collect()
    assert Counter(bytes(c.payload).decode() for c in captures) == Counter(r[2] for r in rows)


def test_archive_members_follow_each_other():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (one * 3, gzip.compress(one) * 3, gzip.compress(one * 3)):
        assert [b for _, b in warc.parse(data)] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.parse(one[:-8]))


# quality


def test_quality_repeats_and_measures():
    assert quality.measure(b"a b c d e f a b c d e")[5] == 10
    assert quality.measure(b"w " * 9)[5] == 9 and quality.measure(b"")[0] == 0
    assert quality.measure("É# é\n\né É#\né É# AB".encode()) == (7, 11, 3, 3, 0, 0, 1)
    assert quality.measure(b"x y\nx y\n \n")[3:5] == (2, 1)


def test_op8_like_sql(spark, odd_docs, docs, tmp_path):
    path = tmp_path / "sf"
    more = docs([(k, prose(k, 3 + k % 20) + " ##" * (k % 7), "en") for k in range(60)])
    odd_docs.unionByName(more).write.parquet(str(path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{path}/documents.parquet/*.parquet'")
    want = con.sql(quality.OP8_SQL)
    found = quality.op8_quality_rules(spark, str(path)).select(want.columns)
    assert Counter(map(repr, map(tuple, found.collect()))) == Counter(map(repr, want.fetchall()))
    assert any(r.kept_without_rule for r in found.collect())


def test_quality_policies_and_ablations(odd_docs):
    found = quality.ledger(odd_docs)
    rows = found.collect()
    assert len(rows) == 10 and quality.ledger(odd_docs.limit(0)).count() == 0
    for r in quality.ablations(found, "strict").collect():
        bit = quality.mask((r.rule,))
        assert r.failing == sum(bool(x.failed & bit) for x in rows)
        assert r.kept_without == sum(not x.failed & ~bit for x in rows)
        assert r.kept_without - r.kept == r.failing_alone


# mixing


def test_exponent_meets_limit_and_entropy():
    tokens = [1000, 100, 10]
    a = mixing.find_exponent(tokens, max_repeats=4)
    assert np.isclose(max(mixing.repeats(tokens, mixing.weights(tokens, a), None)), 4)
    b = mixing.find_exponent(tokens, target_entropy=0.9)
    assert np.isclose(mixing.entropy(mixing.weights(tokens, b)), 0.9)
    assert mixing.find_exponent([5, 5], max_repeats=1) == 0


@pytest.mark.parametrize("budget", [None, 700])
def test_mixture_like_plan(docs, budget):
    r = random.Random(1)
    table = docs([(k, prose(k, r.randint(0, 9)), "en", "big" if k % 4 else f"s{k % 3}") for k in range(200)])
    found = mixing.mix(table, budget=budget, block_rows=16).toPandas()
    texts = table.toPandas()
    texts["n"] = texts.text.str.split().map(len)
    totals = [(s, int(g.n.sum()), len(g)) for s, g in texts.groupby("source")]
    for share in mixing.plan(totals, budget=budget):
        mine = found[found.source == share.source]
        assert mine.mix_tokens.sum() <= share.budget + (0 if budget else 0)
        assert mine.mix_tokens.sum() > share.budget - 12
        for epoch, rows in mine.groupby("mix_epoch"):
            assert rows.doc_id.is_unique
            if (epoch + 1) * share.tokens <= share.budget:
                assert len(rows) == share.rows
        ordered = mine.sort_values(["mix_position", "mix_tokens"])
        assert (ordered.mix_position.diff().dropna() >= 0).all() and mine.mix_at.between(0, 1).all()


def test_mixture_odd_rows(odd_docs):
    found = mixing.mix(odd_docs).toPandas()
    want = Counter((r.doc_id, r.text) for r in odd_docs.collect())
    first = found[found.mix_epoch == 0]
    assert Counter((None if d != d else int(d), t) for d, t in zip(first.doc_id, first.text)) == want
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_op10_writes_whole_documents(spark, monkeypatch):
    written = {}
    write = mixing.materialise
    monkeypatch.setattr(mixing, "materialise", lambda df, name, *how: written.setdefault(name, write(df, name, *how)))
    found = mixing.op10_temperature_mixing(spark, SF)
    had = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    mixed = written["mixture"].collect()
    assert {r.doc_id for r in mixed} == had.keys() and all(r.text == had[r.doc_id].text for r in mixed)
    want = Counter((r.doc_id, r.mix_tokens, r.mix_epoch, r.mix_at) for r in mixed)
    assert Counter(map(tuple, found.select("doc_id", "tokens", "epoch", "at").collect())) == want
