import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from threadmill.session import local_session

    session = local_session("tests", "8", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    """Two folders of the test tables: without any row, and with rows of nulls, a few others, and all of them twice."""
    from pyspark.sql import functions as F

    root = tmp_path_factory.mktemp("odd")
    for f in (DATA / "sf0.001").glob("*.parquet"):
        df = spark.read.parquet(str(f))
        df.limit(0).coalesce(1).write.parquet(str(root / "empty" / f.name))
        nulls = spark.range(2).select(*[F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
        rows = nulls.unionByName(df.limit(3))
        rows.unionByName(rows).coalesce(1).write.parquet(str(root / "nulls" / f.name))
    return root
