"""Results do not depend on the session time zone."""

import pytest

from pacewise.plans.queries import registry
from tests.helpers import rows


@pytest.mark.parametrize("name", ["norm_date", "norm_time", "split_year_filter", "clean_join", "lane_histogram", "feed_file_selection"])
def test_same_rows_in_taipei_and_new_york(spark, tables, name):
    zone = "spark.sql.session.timeZone"
    want = rows(registry()[name](spark, tables))
    try:
        for other in ("Asia/Taipei", "America/New_York"):
            spark.conf.set(zone, other)
            assert rows(registry()[name](spark, tables)) == want
    finally:
        spark.conf.set(zone, "UTC")
