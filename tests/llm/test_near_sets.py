"""Small n-gram sets that differ in one member, against the definition."""

import random

import pytest

from wharfline.llm import ngram_join


@pytest.mark.parametrize("k, num, words", [(3, 90, 11), (5, 80, 8)])
def test_a_text_and_the_same_with_one_word_more(docs_table, k, num, words):
    """9 of 10 and 4 of 5 shingles; no other text has any of them."""
    rows = []
    for i in range(40):
        text = " ".join(f"w{i}x{j}" for j in range(words))
        rows += [(2 * i, text), (2 * i + 1, f"{text} more{i}" if i % 2 else f"more{i} {text}")]
    got = ngram_join.join_documents(docs_table(rows), k=k, num=num, den=100).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in range(80)}
    if k == 5:
        kept = ngram_join.drop_near_copies(docs_table(rows)).collect()
        assert {r.doc_id for r in kept} == {2 * i for i in range(40)}


@pytest.mark.parametrize("num", [50, 70, 80, 90, 100])
def test_similar_sets_share_as_many_probes_as_required(num):
    rng = random.Random(num)
    for _ in range(5000):
        n = rng.randint(1, 60)
        m = rng.randint(-(-num * n // 100), 100 * n // num)
        least = ngram_join.overlap_needed(n + m, num, 100)
        if least > min(n, m):
            continue
        common = rng.randint(least, min(n, m))
        values = list(range(n + m - common))
        if rng.random() < 0.5:
            rng.shuffle(values)      # else what only one of them has comes first
        own, other, both = values[:n - common], values[n - common:n + m - 2 * common], values[n + m - 2 * common:]
        a, b = (sorted(x + both)[:ngram_join.probe_size(len(x) + common, num, 100)] for x in (own, other))
        shared = len(set(a) & set(b))
        assert shared >= ngram_join.probes_shared(n, num, 100) >= 1
        assert shared >= ngram_join.probes_shared(m, num, 100) >= 1
