import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfcast.session import get_session  # noqa: E402
from shelfcast.sources.staging import clear_stages  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "shelfcast-tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("stages")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_stages(session)
    session.stop()


SALE_COLUMNS = "data_date int, goods_id long, sku_id long, goods_num float, goods_price double"


@pytest.fixture(scope="session")
def sales(spark):
    """Two goods: goods 1 with variants 11, 12, 13 and goods 2 with variant 21."""
    return spark.createDataFrame(
        [
            (20170301, 1, 11, 2.0, 10.0),
            (20170302, 1, 11, 4.0, 12.0),
            (20170331, 1, 11, 9.0, 11.0),
            (20170331, 1, 11, 1.0, 15.0),
            (20170302, 1, 12, 5.0, 10.0),
            (20170405, 2, 21, 7.0, 30.0),
            (20170405, 1, 13, 7.0, 8.0),
        ],
        SALE_COLUMNS,
    )


@pytest.fixture(scope="session")
def relation(spark):
    return spark.createDataFrame(
        [(1, 11), (1, 12), (1, 13), (2, 21), (3, 31)], "goods_id long, sku_id long"
    )
