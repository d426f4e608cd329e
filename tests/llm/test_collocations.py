"""Phrase collocations: prefix-free parse against a plain count of every n-gram occurrence."""

import random
import re

import numpy as np
import pyarrow as pa

from articlelake.llm import collocations as co
from articlelake.session import settle


def brute(rows, top=co.TOP, min_count=co.MIN_COUNT):
    f, n = {}, {}
    for text, lang in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] = n.get(lang, 0) + len(words)
            for m in range(1, 5):
                for s in range(len(words) - m + 1):
                    key = (lang, " ".join(words[s:s + m]))
                    f[key] = f.get(key, 0) + 1
    cands = {k: a for k, a in f.items() if a >= min_count and len(k[1].split(" ")) >= 2}
    out = {}
    for (lang, phrase), a in cands.items():
        words = phrase.split(" ")
        if any(len(o.split(" ")) > len(words) and ol == lang and f" {phrase} " in f" {o} " and 100 * b >= 80 * a
               for (ol, o), b in cands.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[(lang, " ".join(words[:k]))], f[(lang, " ".join(words[k:]))]
            cuts.append((co.SCALE * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((score, a, phrase, l, r))
    result = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        for rank, (score, a, phrase, l, r) in enumerate(found[:top], 1):
            result.append((lang, rank, phrase, a, l, r, n[lang], score))
    return sorted(result)


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["New", "york", "city", "hall", "the", "of", "a", "big", "apple", "pie", "é", "Ünter", "x"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            words[0:0] = "new york city hall".split()
        text = " ".join(w + rng.choice(["", "", "", ",", ".", "\n", "\t", "  "]) for w in words)
        rows.append((text, ["en", "de", None][i % 3]))
    shared = " ".join(rng.choice(vocab) for _ in range(200))
    rows += [(shared, "en")] * 40  # a passage in many documents: one dictionary entry
    rows += [(None, "en"), ("", None), ("a a a a a a a a", "fr"), ("LONG " * 5000, "fr"), (" a\tb ", "fr")]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, l, 7) for i, (t, l) in enumerate(rows)], "doc_id long, text string, lang string, rank int")
    got = sorted(tuple(r) for r in co.collocations(df).collect())
    assert got == brute(rows)
    assert len({r[0] for r in got}) >= 2 and any(r[0] == "fr" and r[2] == "long long long long" for r in got)


def test_small_top_and_ties(spark):
    rows = [("p q r s. " * 40, "en"), ("p q. " * 40, "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in co.collocations(df, top=2).collect())
    assert got == brute(rows, top=2)


def test_parse_counts_each_occurrence_once(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "text string, lang string")
    counts = {(r.lang, r.phrase): r.f for r in co.ngram_counts(co.chunk_dictionary(df)).collect()}
    f = {}
    for text, lang in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for m in range(1, 5):
                for s in range(len(words) - m + 1):
                    key = (lang or "und", " ".join(words[s:s + m]))
                    f[key] = f.get(key, 0) + 1
    assert counts == f


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_shuffled_join_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = corpus(7)
    monkeypatch.setattr(co, "BROADCAST_ROWS", 0)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in co.collocations(df).collect()) == brute(rows)


def test_levels_are_counted_as_numbers(spark):
    """n-grams reach the shuffle as numbers, added up over batches, not as text batch by batch."""
    rows = corpus(9)
    dictionary = co.chunk_dictionary(spark.createDataFrame(rows, "text string, lang string"))
    names = sorted((r.lang, r.phrase) for r in co.frequent_ngrams(dictionary).where("size = 1").collect())
    numbers = {lang: {word: i for i, (of, word) in enumerate(names) if of == lang} for lang, _ in names}
    share = spark.sparkContext.broadcast
    numbered = co._numbered(dictionary.coalesce(1), share(numbers))
    partial = co._longer_counts(numbered, len(names), share([])).collect()
    found = {tuple(names[i] for i in divmod(r.key, len(names))): r.freq for r in partial}
    assert len(found) == len(partial)
    exact = {(r.lang, r.phrase): r.f for r in co.ngram_counts(dictionary).where("size = 2").collect()}
    frequent = set(names)
    assert {(a[0], f"{a[1]} {b[1]}"): f for (a, b), f in found.items()} == {
        (lang, phrase): f for (lang, phrase), f in exact.items() if all((lang, word) in frequent for word in phrase.split(" "))}


def test_level_beyond_the_bound_after_numbered_ones(spark, monkeypatch):
    rows = corpus(8)
    dictionary = co.chunk_dictionary(spark.createDataFrame(rows, "text string, lang string"))
    sizes = [row["count"] for row in co.frequent_ngrams(dictionary).groupBy("size").count().orderBy("size").collect()]
    assert sizes[0] < sizes[1]
    monkeypatch.setattr(co, "BROADCAST_ROWS", sizes[0])
    df = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in co.collocations(df).collect()) == brute(rows)


def test_levels_beyond_the_bound_stay_numbers(spark, monkeypatch):
    """More frequent bigrams and trigrams than may be sent as rows are not counted as text."""
    rows = corpus(10)
    dictionary = settle(co.chunk_dictionary(spark.createDataFrame(rows, "text string, lang string")))
    counts = co.frequent_ngrams(dictionary)
    n_words, n_longer = counts.where("size = 1").count(), counts.where("size > 1").count()
    assert n_words < n_longer
    monkeypatch.setattr(co, "BROADCAST_ROWS", n_words)
    monkeypatch.setattr(co, "_grams", None)
    found = {(r.lang, r.phrase): r.f for r in co.frequent_ngrams(dictionary).collect()}
    monkeypatch.undo()
    assert found == {(r.lang, r.phrase): r.f for r in co.ngram_counts(dictionary).where(f"f >= {co.MIN_COUNT}").collect()}


def test_shared_bits_change_no_count(spark, monkeypatch):
    rows = corpus(11)
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(co, "MOST_BITS", 6)
    assert sorted(tuple(r) for r in co.collocations(df).collect()) == brute(rows)


def test_words_are_found_as_text(monkeypatch):
    """Words of one hash are not mistaken for each other."""
    hashes = co._hashes
    monkeypatch.setattr(co, "_hashes", lambda langs, words, seed: hashes(langs, words, seed) % np.uint64(2 + 997 * seed))
    words = co.Words(pa.array(["en", "de", "en"]), pa.array(["a", "a", "b"]))
    assert words.seed > 0 and len(words) == 3
    langs, asked = ["en"] * 40 + ["de", "fr", "en", "de"], [f"w{i}" for i in range(40)] + ["a", "a", "b", "b"]
    found = words.numbers(pa.array(langs), pa.array(asked)).tolist()
    spelled = [(words.langs[i].as_py(), words.words[i].as_py()) if i >= 0 else None for i in found]
    assert spelled == [None] * 40 + [("de", "a"), None, ("en", "b"), None]
    assert co.Words(pa.array([], pa.string()), pa.array([], pa.string())).numbers(pa.array(["en"]), pa.array(["a"])).tolist() == [-1]
