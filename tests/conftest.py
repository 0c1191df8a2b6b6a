import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from aerolith.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A path for a table that nothing has used before."""
    return lambda name="table": str(tmp_path / f"{name}-{uuid.uuid4().hex[:8]}")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


FLIGHT_FIELDS = (
    "year int, month int, dayofmonth int, carrier string, flight_num string, origin string, "
    "dest string, dep_time int, dep_delay double, arr_delay double, cancelled int, seq int"
)


@pytest.fixture
def flights(spark):
    """Flights from dicts; unnamed columns take the values of an ordinary flight."""

    def make(*rows):
        usual = dict(
            year=2018,
            month=1,
            dayofmonth=7,
            carrier="aa",
            flight_num="10",
            origin="jfk",
            dest="lax",
            dep_time=1230,
            dep_delay=5.0,
            arr_delay=10.0,
            cancelled=0,
        )
        data = [usual | {"seq": i} | row for i, row in enumerate(rows)]
        names = [part.strip().split(" ")[0] for part in FLIGHT_FIELDS.split(",")]
        return spark.createDataFrame([[row[n] for n in names] for row in data], FLIGHT_FIELDS)

    return make


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
