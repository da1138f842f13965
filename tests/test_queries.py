"""Every query against its SQL twin (a quick selection unless PALIMPSEST_ALL is set)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUICK = {
    "mask_redact", "mask_partial", "mask_url_params", "mask_regex_documents", "mask_policy_exempt", "mask_hash_batch",
    "mask_structure_diff", "json_path_profile_events", "registry_seed", "registry_skipped", "intake_upsert",
    "intake_number_requests", "match_email_first", "erase_booking", "erase_hits", "no_trace_scan_before",
    "neighbours_untouched", "erase_layer_raw", "no_trace_matrix", "erase_invariants", "bench_groupby_nonpii_field_first",
    "perf_collect", "perf_summary_best", "match_whole_address", "erase_whole_address", "erase_hits_in_place", "erase_in_place_files",
    "indexed_rows", "indexed_files", "redact_lines_in_place", "mask_structure_diff_mixed", "json_path_profile_mixed",
    "erase_by_name_summary", "erase_by_name_manifest", "queue_closed_by_manifest", "match_rule_diff",
}
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def shaped(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_has_a_twin():
    """All but the operators that no SQL expresses, which tests/llm compares with brute force."""
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert not set(entry.oracle_sql()) - set(entry.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


@pytest.mark.parametrize("name", [n for n in NAMES if n in QUICK or os.environ.get("PALIMPSEST_ALL")])
def test_query(spark, sf_dir, duck, name):
    if name not in entry.oracle_sql():
        pytest.skip("compared with brute force in tests/llm")
    df = entry.queries()[name](spark, sf_dir)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert shaped([tuple(r) for r in df.collect()], df.columns) == shaped(result.fetchall(), columns)


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
