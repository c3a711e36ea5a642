import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wakeline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from rows; columns named ``time``/``ts`` hold timestamp text."""
    from pyspark.sql import functions as F

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        for name, kind in df.dtypes:
            if name in ("time", "ts", "start", "stop", "reading_time") and kind == "string":
                df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
        return df

    return make
