import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stratum.session import local_session

    wh = tempfile.mkdtemp(prefix="stratum-warehouse-")
    s = local_session("*", shuffle_partitions=8, app="stratum-tests",
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratum-test-")


@pytest.fixture(scope="session")
def samples(spark):
    from stratum.schemas import ADDRESSES_RAW, CUSTOMERS_RAW, ORDERS_RAW
    from tests import fixtures as fx

    def frames(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "orders": frames(fx.ORDERS_DAY1 + fx.ORDERS_DAY2, ORDERS_RAW),
        "customers_day1": frames(fx.CUSTOMERS_DAY1, CUSTOMERS_RAW),
        "customers_day2": frames(fx.CUSTOMERS_DAY2, CUSTOMERS_RAW),
        "addresses_day1": frames(fx.ADDRESSES_DAY1, ADDRESSES_RAW),
        "addresses_day2": frames(fx.ADDRESSES_DAY2, ADDRESSES_RAW),
    }
