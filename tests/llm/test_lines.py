import random

import pytest

from articlelake.llm import line_runs
from tests.llm.fixtures import documents


def brute_force(rows, min_words):
    """Text and number of deleted lines of each row, from all pairs of runs."""
    docs = []
    for doc_id, text in rows:
        lines = [] if text is None else text.split("\n")
        full = [(at, line) for at, line in enumerate(lines) if line.split()]
        docs.append((2 ** 63 - 1 if doc_id is None else doc_id, lines, full))
    earliest, runs = {}, []
    for row, (key, _, full) in enumerate(docs):
        for i in range(len(full)):
            for way in (range(i, len(full)), range(i, -1, -1)):
                taken, words = [], 0
                for k in way:
                    taken.append(full[k])
                    words += len(full[k][1].split())
                    if words >= min_words:
                        break
                if words >= min_words:
                    name = (way.step, tuple(line for _, line in taken))
                    first, last = min(at for at, _ in taken), max(at for at, _ in taken)
                    place = (key, first)
                    earliest[name] = min(earliest.get(name, place), place)
                    runs.append((row, first, last, name, place))
    gone = [set() for _ in docs]
    for row, first, last, name, place in runs:
        if place > earliest[name]:
            gone[row] |= set(range(first, last + 1))
    return [(doc_id, None if text is None else "\n".join(
        line for at, line in enumerate(lines) if at not in out), len(out))
        for (doc_id, text), (_, lines, _), out in zip(rows, docs, gone, strict=True)]


def rows_of_lines(seed):
    rng = random.Random(seed)
    stock = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 7))) for _ in range(9)] + ["", "  "]
    made = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randrange(0, 25)))) for i in range(25)]
    return made + [(50, None), (51, ""), (52, "\n\n"), (None, made[3][1]), (3, made[3][1]), (60, "a b c\n" * 400)]


@pytest.mark.parametrize(("seed", "words"), [(1, 8), (2, 5), (3, 1), (4, 12)])
def test_equals_brute_force(spark, seed, words):
    rows = rows_of_lines(seed)
    found = line_runs.delete_repeated_runs(documents(spark, rows, "n_lines", "first"), words)
    assert set(found.columns) == {"doc_id", "text", "first", "n_lines", "n_deleted"}
    got = sorted(((r.doc_id, r.text, r.n_deleted) for r in found.collect()), key=repr)
    assert got == sorted(brute_force(rows, words), key=repr)


def test_long_passage_goes_from_later_copies_only(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"start\n{passage}\nend"), (2, f"other\n{passage}\ntail of it"), (3, "clean\ntext"), (4, "start\nend")]
    out = {r.doc_id: r.text for r in line_runs.delete_repeated_runs(documents(spark, rows)).collect()}
    assert out == {1: rows[0][1], 2: "other\ntail of it", 3: "clean\ntext", 4: "start\nend"}


def test_maximal_runs(spark):
    block = "\n".join(f"line {i} of the block" for i in range(30))
    rows = [(1, block), (2, f"x\n{block}\ny"), (3, f"{block}\nz\n{block}")]
    runs = sorted(tuple(r)[::2] + (r["last"],) for r in line_runs.repeated_runs(documents(spark, rows)).select(
        "doc_id", "version", "first", "last").collect())
    assert runs == [(2, 1, 30), (3, 0, 29), (3, 31, 60)]


def test_empty_table(spark):
    assert line_runs.delete_repeated_runs(documents(spark, [])).count() == 0
