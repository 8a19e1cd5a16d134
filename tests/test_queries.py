"""Registered queries against their SQL twins at the smallest scale.

The default run takes one or two queries of each family; ``AGENTLAKE_ALL=1`` takes all."""

import os

import pytest

from agentlake.plans import load_all
from agentlake.plans.registry import QUERIES, TWINS, as_entry, full_twin
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
CORE = (
    "session_summary f04_redact_records w05_title_state w07_slices w09_stop_at_first_failure r03_size_profile c12_usage_deltas c06_codex_to_records "
    "c18_cursor_to_records c17_hash_tree_walk s05_tail_scan s12_build_imports f09_mutating_command j03_resolve_brains j08_apply_misses d06_drop_fired "
    "d07_first_touch a02_governing_artifacts a07_lineage h05_merge_state h07_dormancy h12_recent_failure l06_board_delta m05_sweep st02_import_merge st04_debounce"
).split()

load_all()
NAMES = list(TWINS) if os.environ.get("AGENTLAKE_ALL") else CORE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_twin(spark, con, name):
    assert compare(con, as_entry(name)(spark, SF), full_twin(name)) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)
