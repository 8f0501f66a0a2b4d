import pytest


@pytest.fixture(scope="session")
def sample_folder():
    return "/root/testdata/sf0.01"
