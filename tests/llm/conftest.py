import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Make a documents table from (id, text) or (id, text, lang, source), with a column that clashes with none of ours but could."""

    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:  # names the operators use inside
            for c in ("size", "key", "node", "fp", "root", "rank", "text_hash", "mark", "pos", "row", "shard", "list", "v", "id", "score", "held_out"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df

    return make
