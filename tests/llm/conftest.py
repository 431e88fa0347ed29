import random

import pytest
from pyspark.sql import functions as F

CLASH = ["cid", "row", "n", "h", "kept", "node", "bands", "key", "token", "did", "tk", "spans", "fp", "a", "b", "part", "ids", "rare", "held_out", "score"]


def prose(rng, n):
    syllables = ["ka", "lo", "mi", "tu", "re", "so", "Né", "da", "pi", "wen"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="package")
def rows():
    """(doc_id, text): copies, near copies, shared lines and passages, and every odd case."""
    rng = random.Random(4)
    base = [prose(rng, rng.randint(30, 120)) for _ in range(20)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100 + i, "  ".join(base[i].split(" "))) for i in range(5)]  # equal but for white space
    for i in range(5, 12):  # near copies of near copies
        words = base[i].split(" ")
        for k in range(3):
            words[rng.randrange(len(words))] = "changed%d" % k
            out.append((200 + 10 * i + k, " ".join(words)))
    line = "A shared line that many documents hold"
    out += [(400 + i, f"{base[12 + i][:90]}\n  {line.upper() if i % 2 else line}\t\nend {i}\n{line}") for i in range(5)]
    passage = prose(rng, 80)
    out += [(500 + i, prose(rng, 20) + " " + passage + " " + prose(rng, 20)) for i in range(6)]
    out += [(600, None), (601, ""), (602, " \n\t "), (603, "one"), (604, "two words"), (605, "ONE"), (606, "a" * 900), (607, "ab " * 400)]
    out += [(700, prose(rng, 20_000)), (701, base[0]), (701, base[0]), (None, base[1] + " tail"), (None, None), (702, base[2]), (703, passage)]
    return out


@pytest.fixture(scope="package")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="package")
def none(spark, docs):
    return docs.where("false")
