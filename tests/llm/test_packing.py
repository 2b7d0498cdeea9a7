import numpy as np
import public_tokenizers
import pytest
from llm_corpus import packed_whole
from starmill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(pieces, texts, window=2048):
    packed_whole(pieces, texts, PATH, window)


def test_a_corpus_is_packed_whole(corpus):
    texts = {r.doc_id: r.text for r in corpus.collect()}
    check(packing.pack(corpus.repartition(5), PATH).collect(), texts)
    check(packing.pack(corpus.coalesce(1), PATH, window=64, quantum=16).collect(), texts, 64)


def test_windows_have_the_target_shares(corpus):
    rows = packing.pack(corpus.repartition(3), PATH, window=1024, quantum=64).collect()
    source = {r.doc_id: r.source for r in corpus.collect()}
    totals, windows = {}, {}
    for p in rows:
        totals[source[p.doc_id]] = totals.get(source[p.doc_id], 0) + p.length
        window = windows.setdefault(p.sequence_id, {})
        window[source[p.doc_id]] = window.get(source[p.doc_id], 0) + p.length
    whole = sum(totals.values())
    for window in windows.values():
        if sum(window.values()) == 1024:
            for name, total in totals.items():
                assert abs(window.get(name, 0) - 1024 * total / whole) <= 3 * 64


def test_targets_are_met_until_a_queue_is_empty(corpus):
    rows = packing.pack(corpus, PATH, targets={"s0": 1, "s1": 1, "s2": 2}, window=1024, quantum=64)
    source = {r.doc_id: r.source for r in corpus.collect()}
    first = {}
    for p in rows.collect():
        if p.sequence_id < 3:
            first[source[p.doc_id]] = first.get(source[p.doc_id], 0) + p.length
    assert abs(first["s2"] - 1536) <= 128 and abs(first["s0"] - 768) <= 128


def test_odd_rows(odd, clashing, none, odd_rows, spark):
    unique = [(i, r[1], r[3]) for i, r in enumerate(odd_rows)]
    df = spark.createDataFrame(unique, "doc_id long, text string, source string")
    check(packing.pack(df, PATH).collect(), {i: t for i, t, _ in unique})
    assert packing.pack(clashing, PATH).agg({"length": "sum"}).first()[0] == packing.pack(
        odd, PATH).agg({"length": "sum"}).first()[0]
    assert packing.pack(none, PATH).count() == 0


def test_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    texts = {i: f"text number {i} " * (i % 5 + 1) for i in range(60)}
    df = spark.createDataFrame([(i, t, f"s{i % 11}") for i, t in texts.items()],
                               "doc_id long, text string, source string")
    check(packing.pack(df.repartition(4), PATH, window=64, quantum=8).collect(), texts, 64)


@pytest.mark.parametrize("totals,weights", [([1000, 300, 7], [1 << 20, 314573, 7340]), ([5], [1])])
def test_quanta_tile_the_tokens(totals, weights):
    queue = np.concatenate([np.full(-(-t // 16), i) for i, t in enumerate(totals)]).astype(np.int64)
    number = np.concatenate([np.arange(-(-t // 16)) for t in totals]).astype(np.int64)
    at = packing.tokens_before(queue, number, np.array(totals), np.array(weights), 16)
    size = np.minimum(16, np.array(totals)[queue] - 16 * number)
    order = np.argsort(at)
    assert (at[order] == np.cumsum(size[order]) - size[order]).all()
    assert at[order][-1] + size[order][-1] == sum(totals)
