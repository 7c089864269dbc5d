import pytest

from dfinsight.plans.views import messy_events, table, task_log, titles
from tests.conftest import SF001, SF01


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_views_keep_every_source_row(spark, sf):
    assert titles(spark, sf).count() == table(spark, sf, "orders").count()
    n_events = table(spark, sf, "events").count()
    assert messy_events(spark, sf).count() == n_events
    assert task_log(spark, sf).count() == n_events


def test_views_do_not_touch_session_views(spark):
    table(spark, SF001, "region").createOrReplaceTempView("orders")
    titles(spark, SF01)
    assert spark.table("orders").count() == 5  # the caller's own view named orders is untouched
    spark.catalog.dropTempView("orders")


def test_long_tail_labels_are_cut_by_having_and_by_the_limit(spark):
    from dfinsight.plans import movies
    from dfinsight.plans.views import long_tail
    base = movies.analysis_base(long_tail(spark, SF01, 3.0))
    assert movies.country_report(base, k=100).count() > 15 == movies.country_report(base).count()
    base = movies.analysis_base(long_tail(spark, SF01, 1.2))
    assert movies.country_report(base, min_count=1).count() > movies.country_report(base).count()


def test_the_bom_reaches_the_reader(spark, tmp_path):
    import glob

    from dfinsight.sources import io
    io.land_csv(spark.range(3).toDF(f"{io.BOM}id"), str(tmp_path / "csv"))
    assert all(open(p, "rb").read(3) == b"\xef\xbb\xbf" for p in glob.glob(str(tmp_path / "csv" / "*.csv")))
    assert io.read_csv(spark, str(tmp_path / "csv")).columns == ["id"]
