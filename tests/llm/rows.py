"""Rows for the operator tests."""

SMALL = "/root/testdata/sf0.001"


def make_docs(spark, rows, extra=""):
    """DataFrame with the columns of ``documents`` (and more) from dicts."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
