import zlib

import numpy as np

from starmill.llm import language_id as L


def test_held_out_documents_are_recognised(corpus):
    rows = L.identify(corpus.drop("source")).collect()
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == 330 and all(
        r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0.0 <= r.score <= 1.0 for r in rows)


def test_every_label_is_learned(spark):
    """40 languages of one letter pair each, in language order and with one frequent language."""
    rows = []
    for n in range(40):
        pair = chr(97 + n % 20) + ("qz" if n < 20 else "xw")
        rows += [(len(rows) + i, " ".join([pair * 3] * 20), f"l{n:02}") for i in range(600 if n == 3 else 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    model = L.train(df, rows=1000, least=20)
    assert len(model.languages) == 40
    found = {r.doc_id: r.lang_pred for r in L.predict(df, model).collect()}
    assert all(found[d] == name for d, _, name in rows)
    small = L.train(df, size=40 * 1500)
    assert len(small.languages) == 40


def test_predictions_read_only_the_text(corpus):
    model = L.train(corpus)
    other = corpus.selectExpr("doc_id + 1000 AS doc_id", "text")
    a = {r.doc_id: r.lang_pred for r in L.predict(corpus, model).collect()}
    b = {r.doc_id - 1000: r.lang_pred for r in L.predict(other, model).collect()}
    assert a == b


def test_odd_rows(odd, clashing, none):
    rows = L.identify(odd).collect()
    assert len(rows) == 11
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert {(r.lang_pred, r.score) for r in empty} == {("und", 0.0)}
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert L.identify(clashing).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert L.identify(none).count() == 0
    unlabelled = odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in L.identify(unlabelled).collect()} == {"und"}


def test_the_stage_keeps_sure_documents_whole(corpus, clashing, none):
    kept = L.keep_identified(corpus)
    assert kept.columns == corpus.columns and kept.count() == 330
    rest = L.keep_identified(clashing)
    assert rest.columns == clashing.columns
    assert not {1, 2, 3} & {r.doc_id for r in rest.collect()}
    assert L.keep_identified(none).count() == 0


def test_ngrams_of_a_long_text_do_not_depend_on_chunks(monkeypatch):
    table = L.letter_table()
    text = "Der schnelle Fuchs, 12 mal! " * 300
    whole = L.counts(text, table)
    monkeypatch.setattr(L, "CHUNK", 64)
    cut = L.counts(text, table)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert L.counts("123 ... \n", table) is None and L.counts("", table) is None


def test_penalties_make_weights_sparse_and_temperature_lowers_loss():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(300):
        label = int(rng.integers(2))
        columns = np.sort(rng.choice(500, 20, replace=False))
        columns[0] = label
        rows.append((np.unique(columns), np.full(len(np.unique(columns)), 0.2), label))
    dense, sparse = (
        (L.fit_ftrl(rows, 2, 500, l1=penalty) != 0) for penalty in (0.0, 0.5))
    assert sparse.mean() < 0.5 < dense.mean()
    assert sparse[:, :2].all()  # the two columns that tell the labels apart
    logits = np.array([[3.0, 0.0], [3.0, 0.0], [0.0, 3.0], [3.0, 0.0]])
    t = L.fit_temperature(logits, np.array([0, 0, 1, 1]))
    assert t > 1.0  # one confident answer in four is wrong
