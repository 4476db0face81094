import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hallowgrid.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one column over one literal row: ``value(fn, 'text')``."""
    from pyspark.sql import functions as F

    def run(fn, *args, types=None):
        cols = [F.lit(a) if types is None else F.lit(a).cast(types[i]) for i, a in enumerate(args)]
        named = [c.alias(f"a{i}") for i, c in enumerate(cols)]
        df = spark.range(1).select(*named)
        return df.select(fn(*[F.col(f"a{i}") for i in range(len(args))]).alias("v")).first()["v"]

    return run
