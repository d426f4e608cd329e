import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from articlelake.llm import ngram_join
from tests.llm.fixtures import documents, texts


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set()


def brute_force(rows):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in sets if doc_id is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 90 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=repr)


def result(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize(("cluster", "copies"), [(ngram_join.CLUSTER, 32), (400, 32), (150, 1)])
def test_equals_brute_force(spark, monkeypatch, cluster, copies):
    """Also where clusters are cut: into blocks that meet two by two, and by n-gram."""
    monkeypatch.setattr(ngram_join, "CLUSTER", cluster)
    monkeypatch.setattr(ngram_join, "COPIES", copies)
    rows = texts()
    found = ngram_join.similar_documents(documents(spark, rows, "component_id", "n_shingles", "gram"))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert result(found) == brute_force(rows)
    assert any(c != d for d, _, c in brute_force(rows))


def test_empty_table(spark):
    assert ngram_join.similar_documents(documents(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(1, 40), min_size=1, max_size=40), min_size=1, max_size=12))
def test_tree_connects_what_pairs_connect(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    for sides in (None, [i % 2 for i in range(len(sets))]):
        parent = list(range(len(sets)))
        other = list(range(len(sets)))

        def find(p, x):
            while p[x] != x:
                x = p[x]
            return x

        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if 10 * len(x & y) >= 9 * len(x | y) and (sides is None or sides[i] != sides[j]):
                    parent[find(parent, i)] = find(parent, j)
        for a, b in ngram_join.tree_links(arrays, sides):
            assert 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b])
            other[find(other, a)] = find(other, b)
        groups = [defaultdict(set), defaultdict(set)]
        for i in range(len(sets)):
            groups[0][find(parent, i)].add(i)
            groups[1][find(other, i)].add(i)
        assert sorted(map(sorted, groups[0].values())) == sorted(map(sorted, groups[1].values()))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), max_size=4), st.sets(st.integers(61, 99), max_size=4))
def test_linked_sets_share_enough_first_elements(base, gone, more):
    other = (base - gone) | more
    if other and 10 * len(base & other) >= 9 * len(base | other):
        a, b = (set(sorted(s)[:ngram_join.prefix_length(len(s))]) for s in (base, other))
        assert len(a & b) >= max(ngram_join.shared_at_least(len(base)), ngram_join.shared_at_least(len(other)))


def test_words():
    assert len(ngram_join.ngram_set("a b c d e")) == 2  # only ASCII white space parts words
    assert (ngram_join.ngram_set("A B C") == ngram_join.ngram_set("a\nb\x0bc")).all()
    assert len(ngram_join.ngram_set("É a b")) == 1 and (ngram_join.ngram_set("É a b") != ngram_join.ngram_set("é a b")).all()
    assert len(ngram_join.ngram_set(None)) == len(ngram_join.ngram_set(" ")) == 0
    assert len(ngram_join.ngram_set("x y " * 50_000)) == 2


def scattered(rng, changes, n=460):
    """A text, and a copy of it with single words changed far from each other."""
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    copy = list(words)
    for i in range(changes):
        copy[20 + i * (n - 40) // changes] = f"changed{rng.randrange(10 ** 6)}"
    return " ".join(words), " ".join(copy)


@pytest.mark.parametrize(("cluster", "copies"), [(ngram_join.CLUSTER, 32), (400, 32), (150, 1)])
@pytest.mark.parametrize(("n", "num", "den"), [(5, 8, 10), (3, 1, 2)])
def test_other_shares_equal_brute_force(spark, monkeypatch, cluster, copies, n, num, den):
    monkeypatch.setattr(ngram_join, "CLUSTER", cluster)
    monkeypatch.setattr(ngram_join, "COPIES", copies)
    rng = random.Random(3)
    rows = [row for row in texts() if row[0] is not None]
    for i in range(12):  # five-word shares from 0.96 down to 0.76
        rows += zip((1000 + 2 * i, 1001 + 2 * i), scattered(rng, i + 1), strict=True)

    def grams(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()

    sets = [(doc_id, grams(text)) for doc_id, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    between = 0
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and den * len(x & y) >= num * len(x | y):
                between += 10 * len(x & y) < 9 * len(x | y)
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    assert between > 4
    found = ngram_join.similar_documents(documents(spark, rows), n, num, den)
    assert result(found) == sorted(((d, len(s), find(d)) for d, s in sets), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), max_size=9), st.sets(st.integers(61, 99), max_size=9))
def test_sets_of_another_share_have_enough_first_elements_in_common(base, gone, more):
    other = (base - gone) | more
    if other and 10 * len(base & other) >= 8 * len(base | other):
        a, b = (set(sorted(s)[:ngram_join.prefix_length(len(s), 8, 10)]) for s in (base, other))
        assert len(a & b) >= max(ngram_join.shared_at_least(len(s), 8, 10) for s in (base, other))


def test_impossible_shares_are_refused(spark):
    with pytest.raises(ValueError, match="share"):
        ngram_join.similar_documents(documents(spark, []), 5, 11, 10)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 200), min_size=1, max_size=120), st.sets(st.integers(0, 200), max_size=12),
       st.sets(st.integers(201, 400), max_size=12), st.sampled_from([(9, 10), (8, 10), (2, 3)]))
def test_linked_sets_share_a_named_part(base, gone, more, share):
    num, den = share
    other = (base - gone) | more
    rng = np.random.default_rng(7)
    code = rng.integers(0, 1 << 63, 401, np.uint64) << np.uint64(1)
    tells = rng.integers(1, 300, 1 << ngram_join.BITS).astype(float)
    if other and den * len(base & other) >= num * len(base | other):
        a, b = (ngram_join.signatures(np.unique(code[sorted(s)]), tells, num, den) for s in (base, other))
        assert np.intersect1d(a, b).size


def test_unlike_texts_of_frequent_words_do_not_meet(spark, monkeypatch):
    """Their first n-grams are shared by many, but hardly any part; whole sets of these would grow faster than the input."""
    rng, wholes = random.Random(5), []
    rows = [(i, " ".join(f"w{rng.randrange(12)}" for _ in range(150))) for i in range(300)]
    rows += [(1000, rows[0][1] + " w1")]
    whole_sets = ngram_join._whole_sets

    def counted(texts, *args):
        wholes.append(texts.count())
        return whole_sets(texts, *args)

    monkeypatch.setattr(ngram_join, "_whole_sets", counted)
    assert result(ngram_join.similar_documents(documents(spark, rows))) == brute_force(rows)
    assert wholes[0] < 100  # few of the 301 need their whole set
