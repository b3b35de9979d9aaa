"""Every registered query beside its SQL, on the smallest tables."""

import oracle_check
import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    assert oracle_check.compare(spark, connection, name, SF_DIR) is None


def test_entry_has_rows(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["page_id", "url", "n_sentences", "n_words", "n_syllables", "reading_ease"]
    assert frame.count() == 50
