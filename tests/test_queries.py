"""Every query of the core against its SQL on the smallest tables."""

import re

import pytest

from quarrylake.plans import domain, network, questions, star
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES = domain.QUERIES | star.QUERIES | network.QUERIES | questions.QUERIES
ORACLE = domain.ORACLE | star.ORACLE | network.ORACLE | questions.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLE:
        assert compare(spark, con, FOLDER, QUERIES[name], ORACLE[name]) == ""
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", sorted(questions.QUESTIONS))
def test_rows_of_a_question_have_one_order(name):
    """An ORDER BY whose last term is unique: a grouping key, or the ordinals of all of them. One row needs none."""
    sql = questions.QUESTIONS[name]
    top = re.sub(r"\([^()]*\)", "", re.sub(r"\([^()]*\)", "", re.sub(r"\([^()]*\)", "", sql)))  # what is not inside brackets
    if "ORDER BY" not in top:
        last = top[top.rfind("SELECT"):]
        assert "GROUP BY" not in last and ("UNION ALL" in top or re.search(r"(count|sum|avg)\b", last)), name
        return
    terms = [t.strip() for t in re.sub(r"LIMIT \d+", "", top[top.rfind("ORDER BY") + 8:]).split(",")]
    assert not re.search(r" DESC$", terms[-1]), name
