import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        # Names that operators use for results of their own.
        T.StructField("kept", T.StringType()), T.StructField("row", T.StringType()), T.StructField("size", T.StringType()),
        T.StructField("spans", T.StringType()), T.StructField("score", T.StringType()), T.StructField("line_count", T.StringType()),
    ]
)


def sentence(rng, n, words=4000):
    return " ".join(f"w{int(rng.random() ** 2 * words):x}" for _ in range(n))


def odd_texts():
    """Ids and texts: copies, near copies, shared passages and lines, nulls, empties, one very long, odd white space."""
    rng = random.Random(7)
    base, passage, lines = sentence(rng, 160), sentence(rng, 60), [sentence(rng, 6) for _ in range(8)]
    rows = [(i, sentence(rng, rng.randint(1, 150))) for i in range(20, 60)]
    rows += [(i, base) for i in (3, 5, 70, 71)]
    for i in range(80, 92):
        words = base.split()
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(160)] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    for i in range(100, 106):
        rows.append((i, f"{sentence(rng, 30)} {passage} {sentence(rng, 40)}"))
    for i in range(110, 116):
        own = [sentence(rng, 5) for _ in range(6)]
        rows.append((i, "\n".join([*own[:3], *lines[i % 3 : 4 + i % 4], "", *own[3:]])))
    rows += [(120, None), (121, ""), (122, " \n\t\n"), (123, "one"), (124, "one"), (125, "A b\xa0C\u2003d e"), (126, "a b\xa0c\u2003d e")]
    rows += [(127, "Éa \x1c ü\x0bß � 漢字 " * 30), (128, "same " * 400), (129, "la\nla\nla\nla\nla\nla\n" * 3)]
    rows += [(130, sentence(rng, 6000)), (131, "x" * 5000 + " " + "y" * 300), (132, f"{passage}\n{passage}")]
    rows += [(140, passage), (140, passage), (141, "B C d e f g"), (141, "h i j k l m"), (None, base), (None, sentence(rng, 30))]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, tmp_path_factory):
    """The odd texts as a stored table over several files."""
    rows = odd_texts()
    random.Random(1).shuffle(rows)
    langs, sources = ["en", "de", None], ["a", "b", "c", None, "Ä"]
    data = [(d, t, langs[i % 3], sources[i % 5], len(t or ""), "k", "r", "s", "p", "c", "l") for i, (d, t) in enumerate(rows)]
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def odd_rows(odd_docs):
    return [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
