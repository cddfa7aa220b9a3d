import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qtrlens.session import build_session  # noqa: E402

# ---------------------------------------------------------------- fixed values
# The 23-row long revenue sample (fixture F-A in FIXTURES.md).
SAMPLE_CSV = """ClientID,Region,Country,Date,Revenue
C001,Americas,US,2024-01-15,1000
C001,Americas,US,2024-02-15,1100
C001,Americas,US,2024-03-15,1200
C001,Americas,US,2024-04-15,900
C001,Americas,US,2024-05-15,950
C001,Americas,US,2024-06-15,1000
C002,EMEA,UK,2024-01-20,2000
C002,EMEA,UK,2024-02-20,2000
C002,EMEA,UK,2024-03-20,2000
C003,APAC,IN,2024-04-10,500
C003,APAC,IN,2024-05-10,700
C003,APAC,IN,2024-06-10,800
C004,EMEA,DE,2024-01-12,1500
C004,EMEA,DE,2024-02-12,1400
C004,EMEA,DE,2024-03-12,1300
C004,EMEA,DE,2024-04-12,1200
C004,EMEA,DE,2024-05-12,1100
C004,EMEA,DE,2024-06-12,1000
C005,APAC,AU,2024-01-05,300
C005,APAC,AU,2024-03-05,300
C005,APAC,AU,2024-04-05,500
C005,APAC,AU,2024-05-05,500
C006,Americas,US,2024-05-15,2500
"""
# -----------------------------------------------------------------------------

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="qtrlens-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample_path(tmp_path_factory):
    p = tmp_path_factory.mktemp("sample") / "sample_input.csv"
    p.write_text(SAMPLE_CSV)
    return str(p)


@pytest.fixture(scope="session")
def sample(spark, sample_path):
    from qtrlens.sources.readers import read_revenue_csv
    good, rejects = read_revenue_csv(spark, sample_path)
    assert rejects.count() == 0
    return good
