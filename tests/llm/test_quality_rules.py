import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmill.llm.quality_rules import Rule, quality_rules


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    spans = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(spans), set()
    for i, span in enumerate(spans):
        if seen[span] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def measured(df):
    return [
        (r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed), r.kept)
        for r in quality_rules(df).collect()
    ]


def test_odd_rows(odd, clashing, none, odd_rows):
    found = measured(odd)
    assert sorted(map(str, found)) == sorted(
        str((d, brute(t), kept)) for (d, t, *_), (_, _, kept) in zip(odd_rows, found))
    assert not any(kept for _, m, kept in found if m[0] < 20)
    assert sorted(map(str, measured(clashing))) == sorted(map(str, found))
    assert measured(none) == []


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "#x", "\n", "\t", "é😀", "\x0b"]), max_size=60),
                min_size=1, max_size=20))
def test_counts_equal_brute_force(spark, texts):
    joined = [" ".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(joined)), "doc_id long, text string")
    assert {d: m for d, m, _ in measured(df)} == {i: brute(t) for i, t in enumerate(joined)}


def test_a_repeated_window_and_a_rule_table(spark):
    text = " ".join(f"w{i}" for i in range(40)) + " " + " ".join(f"w{i}" for i in range(10))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = quality_rules(df).first()
    assert row.n_repeat_words == 20 and row.base_failed
    row = quality_rules(df, (Rule("longest", "n_words", high=49),)).first()
    assert row.failed_rules == "longest"


def test_no_python_in_the_plan(odd):
    plan = quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("text,kept", [
    ("The quality of the prose is good and it has words of every kind in it. " * 1
     + "It goes on with that for a while, to be more than twenty words.", True),
    ("BUY!! NOW!! THE!! BEST!! OF!! THE!! WEB!! AND!! MORE!! OF!! IT!! FOR!! YOU!! AND!! US!! IN!!"
     " ONE!! PLACE!! TO!! GO!! ON!! WITH!!", False),
])
def test_verdicts(spark, text, kept):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules(df).first().kept is kept
