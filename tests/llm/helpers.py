"""Small tables with the awkward cases every operator must take."""

DOCS = "doc_id long, text string, key string, n long, u long, hash string, shard string"


def awkward(spark, texts, first=0):
    """(doc_id, text) rows with columns whose names the operators use inside."""
    rows = [(i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1],
             "k", 1, 2, "h", "s") for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
