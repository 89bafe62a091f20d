"""How often a query reads and shuffles its wide rows."""

from __future__ import annotations

from eventweave.plans import registry

SF = "/root/testdata/sf0.001"


def vector_scans(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [vec_id" in line for line in plan.split("\n"))


def test_rolling_distances_join_vectors_once(spark):
    assert vector_scans(spark, "rolling_distance_stats") == vector_scans(spark, "pair_distances") == 1


def test_diagnostics_read_scores_from_a_work_table(spark):
    """The scores of the pairs are made once, though they are joined several times."""
    assert vector_scans(spark, "boundary_diagnostics") == vector_scans(spark, "edge_review") == 0


def test_export_markers_round_nothing(spark):
    """Each pair of a set and a clip is a row, so what is done for a row counts: whole milliseconds need no rounding."""
    plan = registry.queries()["export_markers"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan
