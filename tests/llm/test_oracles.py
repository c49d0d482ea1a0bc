"""The queries with a DuckDB text, side by side on a small scale."""

import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck_connection

from vigil.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck_connection(SF_SMALL).execute(ORACLE[name])
    status, detail = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert status in ("OK", "APPROX"), f"{status} {detail}"


def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op3_language_spans"](spark, SF_SMALL).join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
