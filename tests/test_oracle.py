"""Every registered query with SQL gives the rows DuckDB gives."""

import os
import subprocess
import sys

import pytest
from compare import connect, difference

import __spark_entry__ as entry_point
from workload.oracle import oracle_sql
from workload.queries import registry

ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(medium):
    # The size that shows rows which the smallest tables do not have.
    return connect(medium)


def test_registry_covers_oracle():
    assert set(ORACLE) <= set(entry_point.queries())
    assert set(registry()) - set(oracle_sql()) == {"kmeans_ml", "zone_clusters_ml", "score_model_stream"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, medium, con, name):
    assert difference(entry_point.queries()[name](spark, medium), con, ORACLE[name]) is None


def test_import_needs_no_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert len(e.queries()) > len(e.oracle_sql()) > 60"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.columns == ["window_start", "window_end", "pickup_borough", "trip_count", "avg_total_amount"]
    assert rows.count() > 0


def test_published_counts(spark, medium):
    todo = entry_point.queries()
    flags = {r["quality_flag"]: r["n"] for r in todo["flag_coverage"](spark, medium).collect()}
    assert flags == {
        "VALIDE": 7855, "MONTANT_NEGATIF": 765, "DISTANCE_NULLE": 437, "LOCATION_NULLE": 276,
        "ANOMALIE_STATISTIQUE": 257, "DISTANCE_ABERRANTE": 208, "INVERSION_TEMPS": 202,
    }
    clusters = {r["prediction"]: r["n"] for r in todo["cluster_distribution"](spark, medium).collect()}
    assert clusters == {0: 1211, 1: 3347, 2: 1141, 3: 1015, None: 1141}
    late = {r["delay"]: r["n_late"] for r in todo["watermark_loss_whatif"](spark, medium).collect()}
    assert late == {"1 minute": 438, "5 minutes": 414, "60 minutes": 1}
    assert todo["drift_onset"](spark, medium).first()[0] == 16
    kpi = todo["kpi_window_stream"](spark, medium)
    # One trip in twenty arrives after its window has closed.
    assert 9_490 <= kpi.groupBy().sum("trip_count").first()[0] <= 9_500
    assert todo["anomaly_rate_sliding"](spark, medium).count() == 1165
