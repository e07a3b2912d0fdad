import check
import pytest
from conftest import FOLDER

from threadlens.llm.queries import CHECKS, QUERIES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_against_sql(spark, name):
    outcome = check.compare(QUERIES[name](spark, FOLDER), check.connect(FOLDER), CHECKS[name])
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


def test_names_and_columns():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


COLUMNS = {
    "op3_html": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op4_quality": ("documents", {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"}),
    "op7_language": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op10_toxicity": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_its_contract_for_every_row(spark, name):
    source, columns = COLUMNS[name]
    got = QUERIES[name](spark, FOLDER)
    assert dict(got.dtypes) | columns == dict(got.dtypes)
    key = next(iter(columns))
    rows = got.collect()
    given = spark.read.parquet(f"{FOLDER}/{source}.parquet").select(key)
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in given.collect())
    assert not any(r[c] is None for r in rows for c in columns)
    if "score" in columns:
        assert all(0 <= r.score <= 1 for r in rows)
