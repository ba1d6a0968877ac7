import random

import pytest
from pyspark.sql import types as T

#: Columns that clash with names used inside the operators.
EXTRA = ["row", "score", "cls", "key", "h", "size", "bucket", "kept", "mark", "doc", "id", "raw", "n", "comp", "copy", "_id", "block", "vec", "shard", "payload"]


def make_docs(seed=3, n=60):
    """Small corpus: copies, near copies, shared passages, nulls, empties, ties of source, a long text."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(400)]
    sent = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage = sent(60)
    texts = [sent(r.randint(30, 120)) for _ in range(n)]
    for i in range(0, 12):
        w = texts[i].split()
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [sent(20) + " " + passage + " " + sent(15) for _ in range(8)]
    texts += [texts[0], texts[0].replace(" ", "\t\n"), texts[0] + " ", " " + texts[1], texts[2].upper()]
    texts += [None, "", " ", "\n\t", "one", "one", "One", "two words", "a b c d", "a b c d e", "Été 你好 \U0001f600 ß x" * 6]
    texts += [sent(3000), "z" * 5000, (texts[3] + " ") * 3]
    texts += [passage[:200]] * 5
    rows = [(i, t, "en", f"s{r.choice('aabcd')}" if i % 17 else None, 0) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[4], None, "sa", None), (None, None, None, None, None)]
    return rows


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in EXTRA])


@pytest.fixture(scope="session")
def no_docs(spark, docs):
    return spark.createDataFrame([], docs.schema)
