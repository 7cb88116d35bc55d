import os
import sys
import tempfile

import pytest

from fixture_dirs import ROOT, SF_SMALL

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="clickvault-tests-")


@pytest.fixture(scope="session")
def spark(scratch):
    from clickvault.session import local_session

    s = local_session(
        cores="*",
        shuffle_partitions=8,
        scratch=scratch,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from clickvault.oracle.compare import duck_connect

    return duck_connect(SF_SMALL)
