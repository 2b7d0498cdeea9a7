import random
from pathlib import Path

import pytest
import xxhash

from starmill.llm import graph, simhash
from starmill.session import WRITERS


def brute_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    nodes = sorted(root)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in nodes}


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def test_fingerprints_equal_a_plain_count():
    for text in ["", " \n", "one", "One two", "a b c a b c a b c d", "É é x Y z " * 30]:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = lowered.split()
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        want = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text) == signed(want)


@pytest.mark.parametrize("crowd", [False, True])
def test_links_lose_no_component(spark, crowd):
    rng = random.Random(3)
    prints = {signed(rng.getrandbits(64)) for _ in range(60)}
    for _ in range(6):  # chains in which neighbours differ by two bits
        at = rng.getrandbits(64)
        for _ in range(8):
            at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(signed(at))
    if crowd:  # many fingerprints around one centre share both of its segments
        centre = rng.getrandbits(64)
        for _ in range(250):
            prints.add(signed(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))))
            prints.add(signed(centre ^ rng.getrandbits(8)))
    nodes = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    edges = simhash.links(nodes)
    pairs = edges.collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 and r.a != r.b for r in pairs)
    assert len(pairs) < 70 * len(prints)
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    groups = {}
    for p, root in brute_components(prints).items():
        groups.setdefault(root, set()).add(p)
    mine = {}
    for p in prints:
        mine.setdefault(roots.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (3, 2)], "a long, b long")
    found = {}
    for r in graph.components(edges).collect():
        found.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == [list(range(41)), list(range(1000, 1050))]
    assert graph.components(edges.filter("false")).count() == 0


def test_components_are_few_files_whatever_the_shuffle_partitions(spark, conf):
    """The driver keeps something of every task and file, so small tables are few of both."""
    conf(spark__sql__shuffle__partitions="64", spark__sql__adaptive__coalescePartitions__enabled="false")
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(scratch.glob("components-*"))
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 2000, 2)], "a long, b long")
    assert graph.components(edges).count() == 2000
    written = set(scratch.glob("components-*")) - before
    most = max(len(list(folder.glob("*.parquet"))) for folder in written)
    assert most <= WRITERS * spark.sparkContext.defaultParallelism < 64


def test_components_of_edges_in_parts(spark):
    """Later edges join earlier components, bring new nodes, repeat what is known, or are none."""
    parts = [
        [(1, 2), (3, 4), (10, 11), (11, 12)], [(4, 2), (12, 20), (30, 31), (2, 1)], [],
        [(31, 3), (40, 41), (7, 7)], [(41, 30), (20, 50)],
    ]
    first, *rest = [spark.createDataFrame(p, "a long, b long") for p in parts]
    roots = graph.components(first)
    for part in rest:
        roots = graph.extended(roots, part)
    rows = roots.collect()
    assert len({r.node for r in rows}) == len(rows)
    found = {}
    for r in rows:
        found.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == [[1, 2, 3, 4, 30, 31, 40, 41], [10, 11, 12, 20, 50]]
    assert all(root in nodes for root, nodes in found.items())
    empty = graph.extended(graph.components(first.filter("false")), first)
    assert {r.node for r in empty.collect()} == {1, 2, 3, 4, 10, 11, 12}


def test_odd_rows(odd, clashing, none):
    rows = simhash.near_duplicates(odd).collect()
    zero = "0" * 16
    assert sorted(str(r.doc_id) for r in rows if r.fingerprint == zero) == ["1", "2", "3", "None"]
    assert {r.component_id for r in rows if r.fingerprint == zero} == {1}
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert [r.component_id for r in rows if r.doc_id is None and r.fingerprint != zero] == [None]
    key = lambda r: str(tuple(r))
    assert sorted(map(key, simhash.near_duplicates(clashing).collect())) == sorted(map(key, rows))
    assert simhash.near_duplicates(none).count() == 0


def test_one_document_of_each_group_stays(odd, clashing, none):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "7", "8", "None"]
    assert simhash.keep_one(none).count() == 0


def test_near_copies_are_found(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    near = base.copy()
    near[1500] = "changed"
    df = spark.createDataFrame(
        [(7, " ".join(base)), (9, " ".join(near)), (11, " ".join(reversed(base)))],
        "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    prints = {d: simhash.fingerprint(t) for d, t in df.collect()}
    linked = ((prints[7] ^ prints[9]) & (2**64 - 1)).bit_count() <= 2
    assert found == {7: 7, 9: 7 if linked else 9, 11: 11}
