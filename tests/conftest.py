import os
import sys

import pytest
from hypothesis import HealthCheck, settings

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketlab.session import local_session  # noqa: E402

# Property tests: a fixed example sequence by default (reproducible runs);
# HYPOTHESIS_PROFILE=deep searches ten times wider.
_common = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
settings.register_profile("ci", derandomize=True, max_examples=40, **_common)
settings.register_profile("deep", max_examples=400, **_common)
settings.load_profile(os.environ.get("HYPOTHESIS_PROFILE", "ci"))


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="basketlab-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(params=[True, False], ids=["ansi_on", "ansi_off"])
def ansi(spark, request):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", prev)
