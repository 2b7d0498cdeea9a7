import random

import pytest

import corpus_pipeline
from llm_corpus import SCHEMA, grams
from starmill.llm import minhash


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def rows():
    """Texts of 60 to 600 words, each with a copy of 0.8 or more and one below that."""
    rng, rows = random.Random(4), []
    for group in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 600))]
        for near in (True, False):
            copy, last = base.copy(), None
            while True:
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
                index = jaccard(grams(" ".join(base)), grams(" ".join(copy)))
                if index < 0.8:
                    break
                last = copy.copy()
            rows.append([0, " ".join(last if near else copy)])
        rows.append([0, " ".join(base)])
    crowd = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for i in range(100):  # one large group, in which two copies may be below 0.8
        copy = crowd.copy()
        copy[rng.randrange(200)] = f"y{i}"
        copy[rng.randrange(200)] = f"z{i}"
        rows.append([0, " ".join(copy)])
    rng.shuffle(rows)
    return [(i, text, "aa", "s", None) for i, (_, text) in enumerate(rows)]


def smallest_of_groups(rows):
    """The smallest id of each group that links of 0.8 or more connect, by comparing all pairs."""
    sets = {r[0]: grams(r[1]) for r in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {find(d) for d in sets}


def test_the_stage_finds_what_brute_force_finds(spark, rows):
    want = smallest_of_groups(rows)
    assert len(want) == 2 * 60 + 1
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.near(spark, df, "").collect()} == want


@pytest.fixture(scope="module")
def template():
    """300 texts of one template: two thirds of the words are shared, and some are near copies."""
    rng = random.Random(9)
    frame = [f"t{i}" for i in range(400)]
    texts = []
    for i in range(300):
        own = [f"o{i}x{rng.randrange(10**6)}" for _ in range(rng.choice([60, 120, 200]))]
        text = frame + own
        for copy in range(rng.choice([1, 1, 1, 2, 4])):
            changed = text.copy()
            for _ in range(copy):
                changed[rng.randrange(len(changed))] = f"c{rng.randrange(10**6)}"
            texts.append(" ".join(changed))
    rng.shuffle(texts)
    return [(i, text, "aa", "s", None) for i, text in enumerate(texts)]


def test_crowded_buckets_of_unlike_texts(spark, template, monkeypatch):
    """With one minimum per band most bands are crowded by texts that share the template."""
    monkeypatch.setattr(minhash, "ROWS", 1)
    monkeypatch.setattr(minhash, "CROWD", 4)
    monkeypatch.setattr(minhash, "_BAND_FACTORS", minhash._BAND_FACTORS[:, :1])
    monkeypatch.setattr(minhash, "_FACTORS", minhash._FACTORS[:minhash.BANDS])
    want = smallest_of_groups(template)
    assert 100 < len(want) < len(template) - 100
    kept = minhash.keep_one(spark.createDataFrame(template, SCHEMA))
    assert {r.doc_id for r in kept.collect()} == want


def test_signature_of_a_set():
    assert len(minhash.shingles("")) == len(minhash.bands(minhash.shingles(" \n"))) == 0
    assert list(minhash.shingles("A b")) == list(minhash.shingles("a B "))
    assert len(minhash.shingles("a b c d e f " * 9)) == 6
    assert len(minhash.bands(minhash.shingles("one"))) == minhash.BANDS


def test_odd_rows(odd, clashing, none):
    kept = minhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert minhash.keep_one(none).count() == 0
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in minhash.keep_one(odd).collect())


def test_variants_of_one_text_are_not_compared_with_each_other(spark, monkeypatch):
    """400 variants of a text that is not there itself; most pairs differ by a little too much."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(400):
        copy = base.copy() if i % 4 else texts[-1].split() if texts else base.copy()
        for at in rng.sample(range(150), rng.choice([3, 4]) if i % 4 else 1):
            copy[at] = f"v{i}x{at}"
        texts.append(" ".join(copy))
    rows = [(i, text, "aa", "s", None) for i, text in enumerate(texts)]
    made, crowded = [], minhash._crowded_pairs

    def counting(many, *rest):
        result = crowded(many, *rest)
        made.append((many.select("fingerprint").distinct().count(), result.distinct().count()))
        return result

    monkeypatch.setattr(minhash, "_crowded_pairs", counting)
    want = smallest_of_groups(rows)
    assert 250 < len(want) < 350
    kept = minhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert {r.doc_id for r in kept.collect()} == want
    (members, pairs), = made
    assert members > 300
    assert pairs < 10 * len(rows)


def test_simhash_links_what_no_band_holds(spark):
    """No two sets share a band here, so the links are those of the multi-index hashing."""
    rng, texts = random.Random(6), []
    for group in range(4):
        base = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        for changes in (0, 1, 1, 1, 900):
            copy = base.copy()
            for at in rng.sample(range(2000), changes):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    sets = [minhash.shingles(t) for t in texts]
    bits = [minhash.simhash(s) for s in sets]
    prints = spark.createDataFrame([
        (i, "f", i, i, bits[i], len(sets[i]), [i * minhash.BANDS + j for j in range(minhash.BANDS)])
        for i in range(len(texts))
    ], minhash._PRINTS)
    rows = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file string, row long, text string")
    near = {
        (a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))
        if ((bits[a] ^ bits[b]) & (1 << 64) - 1).bit_count() <= 2
        and jaccard(grams(texts[a]), grams(texts[b])) >= 0.8
    }
    assert len(near) > 6
    found = {(r.a, r.b) for r in minhash.links(prints, rows).collect()}
    assert found <= near and {b for _, b in found} == {b for _, b in near}


def test_the_stage_runs_few_queries_with_short_plans(spark, rows):
    """The driver keeps what it shows of each query, so their number and the plans' length are its memory."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    kept = corpus_pipeline.near(spark, spark.createDataFrame(rows, SCHEMA), "")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    after = store.executionsCount()
    assert kept.count() == 2 * 60 + 1
    last = store.executionsList(int(after) - 1, 1).head()
    assert len(last.physicalPlanDescription()) <= 8 << 10
    assert after - before <= 110, after - before


def test_the_stage_leaves_no_file_lists_in_the_driver(spark, conf):
    conf(spark__sql__hive__filesourcePartitionFileCacheSize=str(250 << 20))
    corpus_pipeline.near(spark, spark.createDataFrame([], SCHEMA), "")
    assert spark.conf.get("spark.sql.hive.filesourcePartitionFileCacheSize") == "0"
