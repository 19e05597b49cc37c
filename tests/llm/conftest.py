import pytest

from tallyhouse.llm._shared import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)
