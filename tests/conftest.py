import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skein.session import build_session, scratch_root

    s = build_session(master="local[*]", app_name="skein-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g",
                             "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    scratch_root(s)
    yield s
    s.stop()
