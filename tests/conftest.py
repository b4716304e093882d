import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strider.session import build_session
    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    return build_session("local[4]", app_name="strider-tests", shuffle_partitions=8,
                         conf={"spark.sql.warehouse.dir": warehouse},
                         checkpoint_fallback=ckpt)
