import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from revrank.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "revrank-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    """Ten users, twelve items, a random log with repeats; user 9 has no rows."""
    import random

    draw = random.Random(7)
    users = [(u, ["A", "B"][u % 2], u / 10, (u * 3 % 7) / 7) for u in range(10)]
    items = [(i, ["x", "y", "z"][i % 3], float(5 + 9 * (i // 2)), i / 12, (i * 5 % 11) / 11) for i in range(12)]
    log = []
    for n in range(70):
        log.append((draw.randrange(9), draw.randrange(12), float(draw.random() < 0.6), n % 4, n))
    return (
        spark.createDataFrame(users, "user_idx long, segment string, user_attr_0 double, user_attr_1 double"),
        spark.createDataFrame(items, "item_idx long, category string, price double, item_attr_0 double, item_attr_1 double"),
        spark.createDataFrame(log, "user_idx long, item_idx long, relevance double, __iter int, l_orderkey long"),
    )
