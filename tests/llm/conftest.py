import pytest


@pytest.fixture
def table(spark):
    """Rows to a DataFrame with columns whose names clash with those operators use inside."""
    def make(rows, schema, extra=("id bigint", "t string", "fp bigint", "row bigint", "words string", "count bigint", "ids string")):
        names = {c.split()[0] for c in schema.split(", ")}
        more = [e for e in extra if e.split()[0] not in names]
        return spark.createDataFrame([(*r, *[None] * len(more)) for r in rows], ", ".join([schema, *more]))

    return make
