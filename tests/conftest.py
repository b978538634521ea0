import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__sql__catalogImplementation="in-memory",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seeds(spark):
    """Staged customers and orders of the five-customer example."""
    customers = spark.sql(
        """SELECT * FROM VALUES (1L, 'Alice', 'east'), (2L, 'Bob', 'west'), (3L, 'Carla', 'east'),
           (4L, 'Dev', 'south'), (5L, 'Elena', 'west') AS t(customer_id, customer_name, region)"""
    )
    orders = spark.sql(
        """SELECT order_id, customer_id, CAST(order_date AS DATE) AS order_date, CAST(order_amount AS DOUBLE) AS
           order_amount, order_status, CAST(last_updated AS TIMESTAMP) AS last_updated FROM VALUES
           (101L, 1L, '2024-02-01', 250.50, 'completed', '2024-02-01 10:00:00'),
           (102L, 2L, '2024-02-15', 89.99, 'completed', '2024-02-15 09:30:00'),
           (103L, 1L, '2024-03-10', 120.00, 'completed', '2024-05-01 09:00:00'),
           (104L, 3L, '2024-03-20', 499.00, 'completed', '2024-03-20 11:45:00'),
           (105L, 4L, '2024-04-05', 75.25, 'cancelled', '2024-04-05 16:00:00'),
           (106L, 2L, '2024-05-10', 310.00, 'pending', '2024-05-10 12:00:00')
           AS t(order_id, customer_id, order_date, order_amount, order_status, last_updated)"""
    )
    return customers, orders


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
