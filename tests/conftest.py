import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskflow.contract import CONTRACT  # noqa: E402
from riskflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("tests", cpus=4, shuffle_partitions=4,
                         spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


def levels(columns, place):
    """For each column one level of its domain, by place."""
    return {c: CONTRACT.domains[c][place % len(CONTRACT.domains[c])] for c in columns}


# 46130.3 is a Sunday, shortly after seven in the morning
TXN = {"Transaction_ID": "row-1", "Customer_ID": "who-1", "Transaction_DateTime": 46130.3, "Amount_NGN": 8125.25,
       **levels(CONTRACT.transaction_categorical, 1)}
PROFILE = {"Age": 41.0, "Tenure_Months": 7.0, "Digital_Engagement_Score": 62.5, **levels(CONTRACT.customer_categorical, 1)}


@pytest.fixture
def txn():
    return dict(TXN)


@pytest.fixture
def enriched():
    return {**TXN, **PROFILE}


@pytest.fixture
def profile():
    return {"Customer_ID": TXN["Customer_ID"], "Customer_Name": "N. N.", "City": "Town", **PROFILE}
