import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from geoqa.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", 8, extra={"spark.driver.memory": "8g"})
    ensure_checkpoint_dir(s)  # local tests: a scratch folder is created when unset
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmpdir_session():
    return tempfile.mkdtemp(prefix="geoqa-test-")
