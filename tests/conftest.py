import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docengine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="8g",
        spark_sql_shuffle_partitions="8",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Value of a column expression for one literal row."""

    def compute(fn, *inputs):
        from pyspark.sql import functions as F

        names = [f"c{i}" for i in range(len(inputs))]
        types = {str: "string", int: "int", type(None): "string", bool: "boolean"}

        def type_of(v):
            return f"array<{types[type(v[0])]}>" if isinstance(v, list) else types[type(v)]

        schema = ", ".join(f"{n} {type_of(v)}" for n, v in zip(names, inputs))
        df = spark.createDataFrame([tuple(inputs)], schema)
        # A plain relation keeps the expression from being folded on the driver only.
        return df.select(fn(*[F.col(n) for n in names]).alias("v")).collect()[0]["v"]

    return compute
