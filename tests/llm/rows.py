"""Small tables with everything that may go wrong in them."""

import random

#: Columns that clash with names the operators use inside.
EXTRA = "id long, k string, t string, fp long, score double, size int, shard int, doc string, words string, n long"


def frame(spark, rows, id_name="doc_id"):
    """(id, text) rows, with extra columns."""
    data = [(i, t, 7, "x", "y", 1, 0.5, 2, 3, "d", "w", 9) for i, t in rows]
    return spark.createDataFrame(data, f"{id_name} long, text string, {EXTRA}").repartition(3)


def words(rng, n, kinds=3000):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def odd_documents(seed=1):
    """Nulls, empties, blanks, a long text, copies, near copies, ties, repeated rows and ids."""
    rng = random.Random(seed)
    long = words(rng, 6000)
    base = [words(rng, rng.choice([3, 20, 80, 300])) for _ in range(25)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(25, 45):  # copies and near copies
        w = list(base[i % 7])
        if i % 2 and len(w) > 100:
            w[5] = "changed"
        rows.append((i, " ".join(w)))
    rows += [(50, None), (51, ""), (52, " \n\t "), (53, " ".join(long)), (54, "a"), (55, "A b"), (56, "a B"), (57, None)]
    rows += [(58, "same " * 400), (59, "same " * 400), (60, "Größe ÄÖ 日本 😀 naïve"), (None, "no id at all"), (None, None)]
    rows += [(3, rows[3][1]), (3, rows[3][1])]
    return rows
