import os

import pytest

from figcurate.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
COLUMNS = {
    "p3_found": ["pmcid_a", "pmcid_b"], "p4_found": ["record_id", "text_field"], "p5_found": ["caption_id_a", "caption_id_b"],
    "p6_found": ["record_id", "text_field"], "p7_found": ["record_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_runs_without_repeated_rows(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    rows = list(map(repr, found.collect()))
    assert rows and len(set(rows)) == len(rows)
    if name in COLUMNS:
        assert found.columns == COLUMNS[name]
