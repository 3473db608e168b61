import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkbook.session import local_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, shuffle_partitions=8, app="sparkbook-tests")
    if s.conf.get("spark.checkpoint.dir", None) is None:
        s.stop()
        s = local_session(4, shuffle_partitions=8, app="sparkbook-tests", shared=str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()
