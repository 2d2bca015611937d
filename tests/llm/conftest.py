import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, n_chars long, d long, t int, th long, pos int, key string, "
          "n_words long, spans string, starts string, label string, score double, ids string, row string")


def make(spark, rows, partitions=3):
    """Documents with extra columns named like the operators' own."""
    data = [(i, t, "en", None if t is None else len(t), 1, 2, 3, 4, "k", 5, "s", "x", "l", 0.5, "i", f"r{n}")
            for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def ordered(df, rows):
    """Collected results in the order of ``rows`` (by the row number kept in the extra column)."""
    got = {int(r.row["row"][1:]): r for r in df.collect()}
    assert sorted(got) == list(range(len(rows)))
    return [got[n] for n in range(len(rows))]


def edge_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, long texts and long words."""
    rng = random.Random(7)
    vocab = [f"w{n}" for n in range(40)] + ["É", "Straße", "x" * 30]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    long = " ".join(rng.choice(vocab) for _ in range(6000))
    body = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    shared = "This Line stands in many documents"
    return [
        (1, f"{body(20)}\n{shared}\n{body(5)}"), (2, f"{shared.upper()}  \n{body(30)}"), (3, f"\t{shared}"),
        (4, None), (5, ""), (6, " \n\t\n "), (7, "\n\n"), (8, "short\nshort\nshort"),
        (9, passage), (10, f"{body(12)} {passage} {body(3)}"), (10, f"{body(9)} {passage}"), (11, f"{passage} {passage}"),
        (None, f"{shared}\n{passage} end"), (None, None), (12, long), (12, long), (13, long + " tail"),
        (14, "a" * 20000), (15, ("b" * 300 + " ") * 60), (16, "é ß 漢字 🙂 one two"), (17, "the of " * 200),
        (18, body(49)), (19, "x\x00y \x1f z w v"), (20, passage.upper()),
        (-5, f"{shared}\nnegative id {body(8)}"),
    ]


@pytest.fixture(scope="module")
def edge(spark):
    rows = edge_rows()
    return rows, make(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
