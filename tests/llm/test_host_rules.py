"""Host rules: counts against a plain reading of the rules, host verdicts, odd rows."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import host_rules as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text: str) -> tuple[int, ...]:
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
        sum(lines[i] in lines[:i] for i in range(len(lines))), len(covered),
    )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é中#|\n\t\x0b\x1c\xa0 ", max_size=120))
def test_counts(text):
    assert H.count_text(text.encode()) == plain_counts(text)


def test_a_bad_host_loses_its_good_documents(spark):
    good = lambda i: " ".join(f"w{i}x{j}" for j in range(12))
    rows = [(i, "bad" if i % 10 else good(i), "junk") for i in range(100)] + [(100 + i, good(i), "fine") for i in range(100)]
    rows += [(200, "bad", "new"), (201, good(201), "new")]
    judged = H.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.doc_id: r.kept for r in H.host_verdicts(judged, "source", "base_failed").collect()}
    assert not any(got[i] for i in range(100)) and all(got[i] for i in range(100, 200))
    assert not got[200] and got[201]
    kept = {r.doc_id for r in H.passing(judged, "source", "base_failed").collect()}
    assert kept == {i for i, k in got.items() if k}


def test_prior():
    assert H.beta_prior(None, None, 0, None, None) == (0.0, None)
    assert H.beta_prior(10, 5, 1, 100, 2.5) == (0.5, None)
    mean, weight = H.beta_prior(200, 100, 2, 20_000, 100 * (0.7**2 + 0.3**2))
    assert mean == 0.5 and 2 < weight < 3


def test_odd_rows(documents, nothing):
    got = H.host_verdicts(H.judge(documents), "source", "base_failed").collect()
    assert len(got) == documents.count() and all(r.kept is not None for r in got)
    assert [r.n_words for r in got if r.doc_id in (0, 1, 2)] == [0, 0, 0]
    assert H.host_verdicts(H.judge(nothing), "source", "base_failed").isEmpty()


@pytest.mark.parametrize("words, kept", [(9, False), (10, True)])
def test_short_documents_fail(spark, words, kept):
    text = " ".join(f"w{i}" for i in range(words))
    judged = H.judge(spark.createDataFrame([(1, text, None)], "doc_id long, text string, source string"))
    assert H.base_failed and judged.first().base_failed is not kept
