import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(autouse=True)
def prepared(spark):
    from fleetfold.llm.common import ready

    ready(spark)
