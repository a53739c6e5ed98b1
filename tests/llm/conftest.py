import pytest


@pytest.fixture
def table(spark):
    """Rows as a table that also has columns whose names operators use themselves."""
    def make(rows, schema="doc_id long, text string", clashing=("fingerprint", "ids", "_spans", "digest", "key")):
        frame = spark.createDataFrame(rows, schema)
        for name in clashing:
            frame = frame.selectExpr("*", f"'x' AS `{name}`")
        return frame
    return make
