"""Each registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from junctura.operators import annotate
from junctura.plans import (
    adapter,
    filequeries,  # noqa: F401  registers its queries
)
from junctura.plans import queries as engine

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    plain = lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted((tuple((x is None, str(plain(x))) for x in r) for r in frame.where(frame.notna(), None).itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(engine.ORACLE))
def test_same_as_sql(spark, tables, name):
    got, want = engine.QUERIES[name](spark, TABLES).toPandas(), tables.sql(engine.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_without_sql_is_the_model():
    assert {n for n in engine.QUERIES if n not in engine.ORACLE} == {"glm_ql_test", "glm_pooled_controls", "glm_batch"}


@pytest.mark.parametrize("name", ["annotation_summary", "file_annotated_matrix"])
def test_annotation_moves_places_alone_and_reads_junctions_once(spark, monkeypatch, name):
    met, read = [], []
    monkeypatch.setattr(annotate, "interval_join", lambda a, *rest, f=annotate.interval_join: met.append(a.columns) or f(a, *rest))
    monkeypatch.setattr(adapter, "junctions", lambda *a, f=adapter.junctions: read.append(a) or f(*a))
    assert engine.QUERIES[name](spark, TABLES).count() > 0
    assert met == [annotate.PLACE] and len(read) == 1
