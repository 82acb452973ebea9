import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chainwatch.session import local_session

    s = local_session("*", shuffle_partitions=8, app="chainwatch-tests")
    yield s
    s.stop()


@pytest.fixture()
def seq_df(spark):
    """Build a long-form token table from {customer: [tokens]}."""

    def make(seqs: dict):
        rows = [(c, i + 1, t) for c, toks in seqs.items() for i, t in enumerate(toks)]
        return spark.createDataFrame(rows, "customer_id string, pos bigint, token string")

    return make
