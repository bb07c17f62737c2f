import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows, extra=False):
        rows = [(*r, None)[:3] if len(r) < 3 else r for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
            "*", "'s' AS source", "cast(length(text) as long) AS n_chars")
        if extra:       # names that the operators use themselves
            for c in ("_id", "_text", "kept", "class", "members", "_hash", "_parts", "label", "n", "shard", "_key", "span", "code", "_dropped_id", "_dropped_hash", "_hash_", "_place_", "_old"):
                df = df.selectExpr("*", f"'x' AS `{c}`")
        return df
    return make


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"), (6, "é" * 50000), (7, "a b c d e f g h " * 3000),
        (8, "\x00 \u0001 \u0002( zero"), (9, "x" * 100000)]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE
