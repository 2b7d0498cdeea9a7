import random
import zlib

import numpy as np

from starmill.llm import quality_classifier as Q


def labelled(spark):
    rng = random.Random(2)
    docs, marks = [], []
    for i in range(400):
        good = i % 4 != 0
        word = lambda: "".join(rng.choice("ka lo mi tu ne ra".split()) for _ in range(3))
        text = " ".join(word() + ("" if good else rng.choice(["###", "!!", "$$$"]))
                        for _ in range(rng.randint(20, 90)))
        docs.append((i, text))
        marks.append((i, int(good)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(marks, "doc_id long, quality int"))


def test_held_out_scores_separate_the_labels(spark):
    docs, marks = labelled(spark)
    truth = {r.doc_id: r.quality for r in marks.collect()}
    rows = Q.score_quality(docs, marks).collect()
    assert len(rows) == 400
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_held_out_labels_teach_nothing(spark):
    docs, marks = labelled(spark)
    fold = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0"
    changed = marks.selectExpr(
        "doc_id", f"CASE WHEN {fold} THEN 1 - quality ELSE quality END AS quality")
    a = sorted(tuple(r) for r in Q.score_quality(docs, marks).collect())
    b = sorted(tuple(r) for r in Q.score_quality(docs, changed).collect())
    assert np.allclose([r[2] for r in a], [r[2] for r in b], atol=1e-6)


def test_odd_rows(spark, odd, clashing, none):
    marks = spark.createDataFrame(
        [(4, 1), (4, 0), (6, 1), (None, 1), (7, None), (99, 0)], "doc_id long, quality int")
    rows = Q.score_quality(odd, marks).collect()
    assert len(rows) == 11 and all(0.0 <= r.score <= 1.0 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert Q.score_quality(clashing, marks).count() == 11
    assert Q.score_quality(none, marks).count() == 0
    untaught = Q.score_quality(odd, marks.filter("false")).collect()
    assert {r.score for r in untaught} == {0.5}


def test_isotonic_pools_falling_neighbours():
    got = Q.isotonic(np.array([1.0, 1, 1, 2]), np.array([0.0, 1, 0, 2]))
    assert got.tolist() == [0.0, 0.5, 0.5, 1.0]


def test_statistics_read_the_whole_text():
    kind = Q.character_classes()
    assert len(Q.statistics("", kind)) == len(Q.statistics("a b", kind)) == len(Q.STATISTICS)
    a, b = "word " * 500_000, "word " * 499_999 + "#### "
    assert Q.statistics(a, kind) != Q.statistics(b, kind)
