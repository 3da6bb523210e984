"""Queries with SQL, compared row by row on the smallest folder."""

from collections import Counter

import pytest

from claimloom.llm import catalog
from tests.compare import connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = connect(FOLDER).execute(catalog.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert want and Counter(tuple(r) for r in df.select(*columns).collect()) == want


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in catalog.QUERIES) == list(range(1, 14))
