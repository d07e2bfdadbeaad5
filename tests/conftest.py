from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from galleyproof import schemas  # noqa: E402
from galleyproof.session import build_session  # noqa: E402

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Desk:
    """Small papers and iterations tables built from the few columns a test cares about."""

    def __init__(self, spark):
        self.spark = spark

    def _rows(self, schema, rows):
        names = schema.fieldNames()
        unknown = {k for r in rows for k in r} - set(names)
        assert not unknown, unknown
        return self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    def papers(self, *rows):
        base = {"journal": "Review", "round": 1, "status": "author_back_de"}
        return self._rows(schemas.PAPERS, [
            base | {"paper_slug": f"Author-{r['paper_id']}"} | r for r in rows])

    def iterations(self, *rows):
        base = {"journal": "Review", "round": 1}
        return self._rows(schemas.ITERATIONS, [
            base | {"paper_slug": f"Author-{r['paper_id']}"} | r for r in rows])

    def reports(self, *rows):
        return self._rows(schemas.REPORTS, [{"journal": "Review", "round": 1} | r for r in rows])

    def ids(self, *ids):
        return self.spark.createDataFrame([(i,) for i in ids], "paper_id string")


@pytest.fixture
def desk(spark):
    return Desk(spark)


def by_id(df, *cols, key="paper_id"):
    """{key: value or tuple} of the chosen columns."""
    rows = {r[key]: tuple(r[c] for c in cols) for r in df.select(key, *cols).collect()}
    return {k: v[0] if len(cols) == 1 else v for k, v in rows.items()}
