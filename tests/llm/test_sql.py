"""Every registered query that SQL can express, against that SQL on the given tables."""

import pytest

from gradewell.llm.oracle import ORACLE_SQL
from gradewell.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    made = QUERIES[name](spark, SF)
    asked = duck(SF).sql(ORACLE_SQL[name])
    assert sorted(made.columns) == sorted(asked.columns)
    wanted = [dict(zip(asked.columns, r)) for r in asked.fetchall()]
    show = lambda rows: sorted(str([(c, r[c]) for c in sorted(r)]) for r in rows)
    assert show(r.asDict() for r in made.collect()) == show(wanted)


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
