import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from oracle import session
    from corpusflow.session import configure
    return configure(session(shared=str(tmp_path_factory.mktemp("shared"))))


@pytest.fixture
def ev(spark):
    """Evaluate a Column builder over literal inputs: ``ev(fn, "text") -> value``."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        names = [f"c{i}" for i in range(len(values))]
        df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'bigint'}" for n, v in zip(names, values)))
        return df.select(fn(*[F.col(n) for n in names]).alias("r")).collect()[0]["r"]
    return run
