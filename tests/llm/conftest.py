import pytest

from facetspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("llm-tests", cores=4, shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
