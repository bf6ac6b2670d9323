"""Rows that every operator on documents must take: nulls, blanks, repeats, long texts."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"
LONG = "a long text that goes on and on. " * 4000


def documents(spark, more=()):
    texts = [*more, None, "", " \n\t ", "é", "one", LONG, "!!! ??? ...", "\U0001f600 smile"]
    data = [(i, t, "en" if i % 3 else None, "src0", None if t is None else len(t), "extra")
            for i, t in enumerate(texts)]
    data += [data[0], data[0], (None, "without an id", None, None, None, None),
             (None, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
