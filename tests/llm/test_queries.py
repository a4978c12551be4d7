"""The registered queries over the smallest tables: columns, row counts and, where there is one, SQL."""

import os

import pytest

from checks.compare import duck
from clipsieve.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_pii": {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string",
    },
    "op4_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op5_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op7_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op8_quality": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
        "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op9_suffix_dedup": {
        "doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string",
    },
    "op10_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op11_spelling": {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint",
    },
    "op12_alignment": {
        "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
        "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string",
    },
    "op13_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"{FOLDER} is not there")
@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    kinds = dict(frame.dtypes)
    assert {k: kinds.get(k) for k in COLUMNS[name]} == COLUMNS[name]
    found = frame.collect()
    connection = duck(FOLDER)
    if name not in ("op4_packing", "op6_neighbours", "op11_spelling"):
        assert len(found) == connection.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert found
    if name in SQL:
        cursor = connection.execute(SQL[name])
        names = [c[0] for c in cursor.description]
        assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == sorted(cursor.fetchall(), key=repr)
