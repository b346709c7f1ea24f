"""Every registered query of the subpackage: its columns, its rows, and its SQL where it has one."""

import duck
import pytest

from logrisk.llm.queries import LLM_ORACLES, LLM_QUERIES

COLUMNS = {
    "op1": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op2": {
        "doc_id": "bigint",
        "n_chars": "bigint",
        "edited_sha256": "string",
        "fingerprint": "string",
        "edited_fingerprint": "string",
        "near_edited": "double",
        "near_next": "double",
    },
    "op3": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op4": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op5": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op6": {"doc_id": "bigint", "class_id": "bigint"},
    "op7": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op8": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op11": {
        "doc_id": "bigint",
        "n": "bigint",
        "form": "string",
        "prefix_chars": "bigint",
        "middle_chars": "bigint",
        "output_sha256": "string",
        "restored_sha256": "string",
    },
    "op12": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op13": {
        "doc_id": "bigint",
        "leaf": "string",
        "subroot": "string",
        "root": "string",
        "proof_sha256": "string",
        "folded_root": "string",
        "verified": "boolean",
    },
    "op10": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
}


def test_one_query_per_operator():
    assert sorted(name.split("_")[0] for name in LLM_QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_columns_and_rows(spark, sf_dir, name):
    df = LLM_QUERIES[name](spark, sf_dir)
    kinds = dict(df.dtypes)
    expected = COLUMNS[name.split("_")[0]]
    assert {column: kinds.get(column) for column in expected} == expected
    rows = df.collect()
    table = {"op3": "pages", "op4": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert len(rows) == (5 * -(-n // 50) if table == "embeddings" else n)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_equals_sql(spark, name, scale):
    folder = f"/root/testdata/sf{scale}"
    assert duck.difference(LLM_QUERIES[name](spark, folder), duck.connect(folder), LLM_ORACLES[name]) is None
