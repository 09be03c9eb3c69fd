import pytest

from ledgerlake.llm.store import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)
