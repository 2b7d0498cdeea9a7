"""The trie against plain dictionaries of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from starmill.llm import prefix_trie as T

SCHEMA = "conv_id long, turn int, role string, text string"


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                  hashlib.sha256(r[2].encode()).digest()))
    members = defaultdict(set)
    ends = defaultdict(list)
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        base = own.get(conv - int(math.fmod(conv, 5)), [])
        path = tuple(r[1:] for r in base[:h] + own[conv][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(conv)
        ends[path].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        size = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below[path] = (
            sum(below[c][0] for c in children[path]) or 1, size + sum(below[c][1] for c in children[path]))
    return sorted((
        min(m), len(path), min(members[path[:-1]]) if path else -1, len(m), len(children[path]),
        *below[path], hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
    ) for path, m in members.items())


def found(df):
    assert df.columns == ("conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens"
                          " ends_sha256").split()
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def random_rows(seed, convs, most, words):
    rng = random.Random(seed)
    for conv in convs:
        shared = rng.random() < 0.7
        for turn in range(rng.randint(1, most)):
            text = f"w{turn % 2}" if shared and rng.random() < 0.95 else rng.choice(words)
            yield conv, turn, ("user", "assistant")[turn % 2], text


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed):
    rows = list(random_rows(seed, range(-40, 200), 22, ["x", "", "é", "yy"]))
    random.Random(seed).shuffle(rows)
    assert found(T.trie(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_copies_and_nested_prefixes(spark, conf):
    """One hot chain of conversations that are prefixes of each other, and many copies."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(60) for turn in range(8 + conv)]
    rows += [(conv, turn, "user", "same") for conv in range(100, 180) for turn in range(9)]
    rows += [(500, turn, "user", f"t{turn % 3}") for turn in range(400)]
    assert found(T.trie(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 3, "a", "long " * 50_000), (1, 3, "a", "b"),
            (5, 0, "user", "Hi"), (5, 0, "user", "Hi"), (6, 2, "user", ""), (7, 1, "", "user"),
            (-7, 1, "user", "\x00"), (-5, 1, "user", None), (2**40, 1, "é", "é")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(T.trie(df)) == expected(rows)
    more = df.selectExpr("*", "1 pos", "2 file", "3 row", "4 trie_file", "5 Trie_Row", "6 key", "7 depth",
                         "8 `a.b`", "9 block")
    assert found(T.trie(more)) == expected(rows)
    assert T.trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.skipif(not TESTDATA.exists(), reason="the given tables are not here")
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert found(entry.queries()["op12_prefix_trie"](spark, str(TESTDATA))) == expected(rows)
