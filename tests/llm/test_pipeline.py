import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_corpus import SCHEMA, grams, packed_whole, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with unknown languages, exact copies, near copies and secrets."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        language = ("aa", "bb", "cc")[i % 3]
        rows.append([i, words(language, rng.randint(30, 200), rng), language, f"s{i % 4}", None])
    base = words("aa", 4000, rng).split()
    for i in range(150, 156):  # near copies: one word of 4000 differs
        copy = base.copy()
        copy[rng.randrange(4000)] = "other"
        rows.append([i, " ".join(copy), "aa", "s0", None])
    rows += [[i, rows[i - 156][1], rows[i - 156][2], "s1", None] for i in range(156, 176)]
    rows += [[176, None, None, None, None], [177, "12345 67890 !!!", None, "s2", None], [178, "", "aa", "s2", 0]]
    rows[3][1] += " password=7602ad27cf5550de1c"
    rows[4][1] += ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    rows[5][1] += " 4111111111111111 here"
    path = tmp_path_factory.mktemp("sf")
    df = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit("x"))
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_do_what_brute_force_does(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        if i < 4:
            assert docs.columns == columns
            assert dict(docs.dtypes) == dict(spark.read.parquet(f"{folder}/documents.parquet").dtypes)
        seen[name] = (before, docs)
    before, after = seen["language"]
    kept = {r.doc_id for r in after.collect()}
    assert set(before) - kept == {176, 177, 178}

    before, after = seen["exact_dedup"]
    groups = {}
    for d, t in before.items():
        groups.setdefault(hashlib.sha256(t.encode()).hexdigest(), []).append(d)
    assert {r.doc_id for r in after.collect()} == {max(g) for g in groups.values()}

    before, after = seen["near_dedup"]
    sets = {d: grams(t) for d, t in before.items()}
    group = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                near = 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
                if near and group[b] < group[a]:
                    group[a], changed = group[b], True
    assert {r.doc_id for r in after.collect()} == set(group.values())
    assert len(set(group.values())) < len(group)  # some near copies went

    before, after = seen["secrets"]
    secret = re.compile("7602ad27cf5550de1c|24be64439e3e49cf46b2d7c90f3602a3d0b907ff")
    assert {r.doc_id: r.text for r in after.collect()} == {
        d: secret.sub("<secret>", t) for d, t in before.items()}
    packed_whole(seen["packing"][1].collect(), seen["packing"][0],
                 public_tokenizers.path("byte_bpe_50k.json"))


def test_run_equals_its_stages(spark, folder):
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert result.count() > 100


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "", "en", "a", 0)] * 2])
def test_tables_without_content(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
