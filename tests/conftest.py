from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weir.session import build_session, run_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="weir-tests",
        shuffle_partitions=4,
        conf={"spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def workdir(spark, request):
    return run_dir(spark, request.node.name.replace("[", "_").replace("]", "_"))
