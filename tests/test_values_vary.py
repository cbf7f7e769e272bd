"""Every registered query, run once on the test tables.

A green comparison proves something only where values vary: no column is constant, apart from
those that are constants by definition.  No plan holds a cross join or Python evaluation.
"""

import contextlib
import io
import os

import pytest

from posting_analytics.plans import driver_queries as Q

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

#: Columns that hold one value by definition.
CONSTANT = {
    "const_columns": {"source_platform", "posted_date", "scraped_at", "source"},
    "extract_postings": {"posted_date", "source_platform"},
    "rejects": {"reason"},
    "table_profile": {"n_rows", "n_null"},  # the test tables hold no NULL
    "missing_rate": {"n_rows"},
}
#: One row by definition.
ONE_ROW = {"distinct_counts", "cluster_quality", "cluster_quality_groups"}
#: Results of a fit, made on the driver from a few numbers.
FITTED = {"elbow", "elbow_groups", "cluster_quality", "cluster_quality_groups", "pca_variance", "pca_plane_variance"}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_values_vary_and_plans_are_native(spark, name):
    df = Q.QUERIES[name](spark, SF)
    pdf = df.toPandas()
    assert len(pdf)
    if name not in ONE_ROW:
        same = {c for c in pdf.columns if len({repr(v) for v in pdf[c]}) < 2}
        assert same <= CONSTANT.get(name, set()), (name, same)
    if name not in FITTED:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        for bad in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in out.getvalue(), (name, bad)
