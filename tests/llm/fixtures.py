"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, clashing columns."""

import random

WORDS = "alpha beta gamma delta river stone cloud tree bird wind lake moss fern dune reef cave".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    base = [sentence(rng, n) for n in (120, 90, 60, 200)]
    rows = [(i, sentence(rng, rng.randrange(1, 80))) for i in range(20)]
    for at, text in enumerate(base):
        words = text.split()
        for copy in range(6):  # near copies: the more changes, the further away
            changed = list(words)
            for _ in range(copy):
                changed[rng.randrange(len(changed))] = "changed" + str(rng.randrange(1000))
            rows.append((100 + 10 * at + copy, " ".join(changed)))
    rows += [(200, base[0]), (201, base[0].upper()), (202, ""), (203, " \n\t "), (204, None), (205, "one"), (206, "one"),
             (207, "two words"), (208, "Two\tWORDS"), (209, "é È " * 30), (None, base[0]), (None, None), (200, base[0])]
    return rows


def documents(spark, rows, *extra: str):
    """``doc_id, text`` and the columns ``extra``, each holding 7."""
    df = spark.createDataFrame(list(rows), "doc_id long, text string")
    for name in extra:
        df = df.selectExpr("*", f"7 as `{name}`")
    return df
