"""Small tables with every odd case, shared by the tests of this folder."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def sentence(r, n):
    return " ".join(r.choice("the of and River stone été naïve 日本 light over under table green walks Ñandú".split()) for _ in range(n))


def make_rows():
    r = random.Random(7)
    rows = []
    shared = [sentence(r, 14) + "." for _ in range(6)]
    passage = " ".join(sentence(r, 12) + "." for _ in range(9))
    for k in range(120):
        parts = [sentence(r, r.randint(1, 30)) + "." for _ in range(r.randint(1, 6))]
        if k % 3 == 0:
            parts.insert(0, "  " + r.choice(shared).upper() + "\t")
        if k % 4 == 0:
            parts.append(r.choice(shared))
        if k % 11 == 0:
            parts.append(parts[0] + " " + passage)
        rows.append((k + 1000, "\n".join(parts), "en", f"s{k % 3}", None))
    rows += [(2000 + k, rows[5][1], "en", "hot", 1) for k in range(12)]            # copies
    rows += [(2100 + k, rows[7][1] + f" tail{k}", None, None, None) for k in range(6)]  # near copies
    rows += [(3000, "", "en", "s", 0), (3001, None, None, None, None), (None, "a text without id, of some length", "x", "y", 2),
             (None, None, None, None, None), (3002, " \n\t ", "en", "s", 4), (3003, "one", "en", "s", 3),
             (3004, "日" * 9, "ja", "s", 9), (3005, "日" * 10, "ja", "s", 10), (3006, "日" * 10 + "\n", "ja", "s", 11)]
    rows += [rows[3], rows[3]]                                                       # repeated rows
    rows.append((4000, "\n".join(sentence(r, 40) for _ in range(3000)), "en", "long", 5))
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
