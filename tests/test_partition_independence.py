"""Results do not depend on the number of shuffle partitions."""

import pytest

from conftest import SF0001
import __spark_entry__ as entry_mod


@pytest.mark.parametrize("key", ["top3_cited_per_conference", "author_h_index",
                                 "pagerank_cites", "scc_cites", "assign_reviewers",
                                 "merge_edges_last_wins", "extract_keywords"])
def test_same_result_with_one_and_many_partitions(spark, key):
    q = entry_mod.queries()[key]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(map(tuple, q(spark, SF0001).collect()), key=repr)
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        many = sorted(map(tuple, q(spark, SF0001).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many
