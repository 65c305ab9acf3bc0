import json

from ledgermatch import registry as RG
from ledgermatch.plans import programs as P
from ledgermatch.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_load_suite_json_backquoted_table():
    text = json.dumps([{"name": "t", "sql": "SELECT SUM(subscription_count) AS t FROM `{table}`", "critical": True}])
    (spec,) = P.load_suite(text)
    assert spec.sql.endswith("FROM {table}") and spec.critical and spec.keys is None


def test_migration_acceptance_program(spark, tmp_path):
    new, old = RG.new_layer(spark, SF_SMALL), RG.old_layer(spark, SF_SMALL)
    cfg = P.RunConfig(output=str(tmp_path / "acc"), output_format="json")
    out = P.migration_acceptance(spark, new, new, cfg=cfg)
    assert out["decision"].first()["migration_accepted"] is True
    assert spark.read.json(str(tmp_path / "acc" / "decision")).count() == 1
    bad = P.migration_acceptance(spark, new, old)
    assert bad["decision"].first()["migration_accepted"] is False


def test_table_comparison_program(spark):
    new, old = RG.new_layer(spark, SF_SMALL), RG.old_layer(spark, SF_SMALL)
    out = P.table_comparison(spark, new, new)
    assert all(r["passed"] for r in out["results"].collect())
    summary = {r["validation_type"]: r["failed"] for r in P.table_comparison(spark, new, old)["summary"].collect()}
    assert summary["schema"] >= 2 and summary["quantity"] >= 1 and summary["ALL"] > 0


def test_source_validation_program(spark):
    rb, old = RG.rebuilder(spark, SF_SMALL), RG.old_layer(spark, SF_SMALL)
    out = P.source_validation(spark, rb, old, RG.SHARED_DIMS, fx.LAYER_METRICS, fx.DERIVED_FORMULAS)
    got = {(r["validation_type"], r["check_name"]): r["passed"] for r in out["results"].collect()}
    assert got[("aggregation", "subscription_count")] is False
    assert got[("derived", "TotalAcquisition")] is False
    assert got[("domain", "tenure_group")] is False
    assert got[("non_negative", "cancellation_count")] is False and got[("non_negative", "acquisition_count")]
    good = P.source_validation(spark, RG.rebuilder(spark, SF_SMALL), RG.new_layer(spark, SF_SMALL),
                               fx.LAYER_DIMS, fx.LAYER_METRICS, fx.DERIVED_FORMULAS)
    ok = {(r["validation_type"], r["check_name"]): r["passed"] for r in good["results"].collect()}
    assert ok[("aggregation", "subscription_count")] and ok[("derived", "NetCancellation")]
