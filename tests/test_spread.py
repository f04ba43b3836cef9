"""Small files of much work are dealt over tasks before the work begins."""

from __future__ import annotations

import pytest

from tracewright.plans import seed_queries, tree_queries


def spread(df) -> list[int]:
    return [n for n in df.rdd.glom().map(len).collect() if n]


def test_order_records_come_in_several_partitions(spark, sf_dir):
    assert len(spread(tree_queries._order_records(spark, sf_dir))) > 1


@pytest.mark.parametrize("query", [tree_queries.output_paths, seed_queries.migrated_seeds, seed_queries.catalogue_seeds])
def test_parts_come_in_several_partitions(spark, sf_dir, query):
    assert len(spread(query(spark, sf_dir))) > 1
