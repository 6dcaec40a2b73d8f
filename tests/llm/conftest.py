import pytest

CLASHING = {"row": 1, "id": "x", "n_words": 5, "kept": None, "score": 0.5, "label": 9, "host": "h", "path": "p", "class_id": 3, "sequence_id": 7, "open": True, "text_a": "t", "c0": 2, "key": 4}
KINDS = {"row": "int", "id": "string", "n_words": "int", "kept": "string", "score": "double", "label": "int", "host": "string", "path": "string", "class_id": "int", "sequence_id": "int", "open": "boolean", "text_a": "string", "c0": "int", "key": "int"}


@pytest.fixture
def table(spark):
    """A frame of rows (dicts) with the columns given as ``name type, ...``, and on request columns of clashing names."""

    def make(columns, rows, clashing=False):
        names = [c.split()[0] for c in columns.split(", ")]
        values = [tuple(r.get(n) for n in names) for r in rows]
        if clashing:
            extra = [n for n in KINDS if n not in names]
            values = [v + tuple(CLASHING[n] for n in extra) for v in values]
            columns += "".join(f", {n} {KINDS[n]}" for n in extra)
        return spark.createDataFrame(values, columns)

    return make


@pytest.fixture
def documents(table):
    def make(texts, clashing=False):
        """Documents from texts, or (id, text)."""
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return table("doc_id long, text string", [{"doc_id": i, "text": t} for i, t in rows], clashing)

    return make


@pytest.fixture
def python_free():
    """Assert that a frame's plan has no Python in it."""

    def check(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))

    return check
