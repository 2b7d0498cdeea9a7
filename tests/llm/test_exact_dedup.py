import hashlib

from pyspark.sql import functions as F

from starmill.llm import exact_dedup


def want(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", []).append(d)
    return sorted(
        (str(d), str(max([x for x in groups[t or ""] if x is not None], default=None)),
         len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
        for d, t, *_ in rows
    )


def found(df):
    rows = exact_dedup.decisions(df).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(kept) == 1 for kept in groups.values())
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows)


def test_odd_rows(odd, clashing, none, odd_rows):
    assert found(odd) == want(odd_rows)
    assert found(clashing) == want(odd_rows)
    assert exact_dedup.decisions(none).count() == 0


def test_one_row_of_each_group_stays_whole(odd, clashing, none):
    kept = exact_dedup.keep_one(clashing)
    assert kept.columns == clashing.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == 7
    assert exact_dedup.keep_one(none).count() == 0 and exact_dedup.keep_one(odd).count() == 7


def test_files_are_located_without_a_copy(spark, odd, tmp_path):
    odd.repartition(3).write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    assert found(stored) == found(odd)


def test_a_digest_of_two_texts_is_told_apart_by_its_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest_of", lambda text: F.lit("collision"))
    df = spark.createDataFrame(
        [(1, "one"), (2, "two"), (3, "one"), (4, None), (5, "two")], "doc_id long, text string")
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.decisions(df).collect()}
    assert rows == {1: (3, 2, False), 3: (3, 2, True), 2: (5, 2, False), 5: (5, 2, True), 4: (4, 1, True)}


def test_only_texts_of_repeated_digests_are_compared(spark):
    rows = spark.range(5000).selectExpr(
        "id AS doc_id", "IF(id % 100 = 0, 'copy', concat('text ', id)) AS text"
    ).withColumn("digest", exact_dedup.digest_of(F.col("text")))
    hits = rows.groupBy("digest").count().filter("count > 1").select("digest")
    found = exact_dedup._of_hits(rows, hits)
    assert found.filter("text = 'copy'").count() == 50
    assert found.count() < 150
    many = rows.filter("doc_id % 3 = 0").select("digest")
    assert {r.digest for r in many.collect()} <= {r.digest for r in exact_dedup._of_hits(rows, many).collect()}
    assert exact_dedup._of_hits(rows, hits.limit(0)).count() == 0


def test_the_state_is_kept_on_disk(spark, odd, monkeypatch):
    seen = []
    original = exact_dedup.seen_state

    def noted(spark, arrivals, folder):
        state = original(spark, arrivals, folder)
        seen.append(spark.read.format("state-metadata").load(folder).first())
        return state

    monkeypatch.setattr(exact_dedup, "seen_state", noted)
    before = {k: spark.conf.get(k, None) for k in exact_dedup.STATE_SETTINGS}
    exact_dedup.decisions(odd).count()
    assert seen and seen[0].operatorName == "stateStoreSave"
    assert {k: spark.conf.get(k, None) for k in exact_dedup.STATE_SETTINGS} == before
