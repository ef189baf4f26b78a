import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TABLES = "customer part orders lineitem events embeddings".split()
# A quick cut through all groups; the driver compares every query.
CHECKED = [
    "load_log", "one_hot", "candidate_cross", "candidates", "segment_category_pivot", "price_by_category_histogram",
    "user_price_profile", "padded_sequences", "bigram_pruned", "item_cosine", "graph_smooth", "graph_scores",
    "random_recommend", "graph_recommend", "embedding_cold_start", "ndcg_at_k",
]


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    if not Path(FOLDER).exists():
        pytest.skip("test tables are not here")
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = database.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    found = entry_points.queries()[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    plain = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    left = sorted(tuple(plain(v) for v in row) for row in want.fetchall())
    right = sorted(tuple(plain(v) for v in row) for row in found.select(*columns).collect())
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, abs_tol=1e-6)) for x, y in zip(a, b)), (a, b)
