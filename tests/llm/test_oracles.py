"""Corpus queries with an SQL twin give its rows; those without one are named here."""

import pytest
from oracle_check import compare, connect

from tallywise.llm import queries as Q

WITHOUT_SQL = {"op2_simhash_near_dedup", "op3_flow_resharding", "op4_ftrl_toxicity", "op5_first_fit_packing",
               "op9_text_density_extraction", "op10_mixture_language_id", "pipeline"}


@pytest.mark.parametrize("name", sorted(Q.oracles()))
def test_same_as_sql(spark, folder, name):
    assert compare(Q.queries()[name](spark, folder), connect(folder), Q.oracles()[name]) == ""


def test_the_rest_has_no_sql():
    assert set(Q.queries()) - set(Q.oracles()) == WITHOUT_SQL
