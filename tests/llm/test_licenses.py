"""Notices over line ends, words near and far apart, and clashing columns."""

from estrato.llm import licenses


def labels(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["labels"], round(r["score"], 3)) for r in licenses.scan(frame).collect()}


def wrapped(text, width):
    words, lines = text.split(), [""]
    for w in words:
        lines = [*lines, w] if len(lines[-1]) + len(w) > width else [*lines[:-1], f"{lines[-1]} {w}".strip()]
    return "\n# ".join(lines)


def test_wrapped_notices(spark):
    long = "filler words stand here before it " * 40
    texts = [long + wrapped(t, width) + " " + long for t, _ in licenses.TEMPLATES for width in (12, 30, 80)]
    got = labels(spark, texts)
    for k, (_, label) in enumerate(x for x in licenses.TEMPLATES for _ in range(3)):
        assert label in got[k][0].split(",") and got[k][1] == 1.0, texts[k]


def test_the_reported_probe(spark):
    got = labels(spark, ["Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
                         " ".join(["all"] + ["x"] * 300 + ["rights"] + ["y"] * 300 + ["reserved"] + ["z"] * 300), "All\nRights\n\nReserved.",
                         "all one two rights three four reserved"])
    assert got[0] == ("bsd", 1.0) and got[1] == ("", 0.0) and got[2] == ("all-rights-reserved", 1.0) and got[3] == ("all-rights-reserved", 1.0)


def test_some_words_may_be_missing(spark):
    template = licenses.TEMPLATES[1][0].split()
    assert labels(spark, [" ".join(template[2:]), " ".join(template[5:])])[0] == ("apache-2.0", round(10 / 12, 3))
    assert labels(spark, [" ".join(template[5:])])[0][0] == ""


def test_odd_tables(spark, docs, no_docs):
    assert licenses.scan(no_docs).count() == 0 and licenses.scan(docs).count() == docs.count()
    odd = spark.createDataFrame([(1, "MIT license", 3, "q"), (None, None, None, None)], "doc_id long, text string, word int, template string")
    assert sorted((str(r["doc_id"]), r["labels"], r["score"]) for r in licenses.scan(odd).collect()) == [("1", "mit", 1.0), ("None", "", 0.0)]
