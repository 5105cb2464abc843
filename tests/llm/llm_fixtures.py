"""Small document tables for the training-data operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside; input columns of these names
#: must neither break nor change them.
CLASHING = ["text_key", "seed", "span", "h1", "h2", "_text", "_words", "_key", "_id", "key", "place",
            "node", "root", "hash", "bytes", "depth", "prefix", "ids", "start", "runs", "label", "score"]


def documents(spark, rows, clashing=True):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src0")), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def prose(rnd, n_words, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n_words))


def odd_rows(rnd):
    """Nulls, empty and blank texts, ties, repeated rows, a long text."""
    base = prose(rnd, 80)
    return [(1, None), (2, ""), (3, " \n\t "), (4, base), (4, base), (4, base + " tail"), (None, base),
            (None, None), (5, "x"), (6, prose(rnd, 20_000)), (7, "é日😀 " * 60), (8, "a" * 900)]
