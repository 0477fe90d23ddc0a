"""All stages over the smallest data set."""

from __future__ import annotations

from pyspark.ml import PipelineModel

from lendlens.plans import stages
from lendlens.sources import fixture

SF = "/root/testdata/sf0.001"


def test_stages_write_their_outputs(spark, tmp_path):
    folder = str(tmp_path / "out")
    apps, inst = fixture.applications(spark, SF), fixture.instalments(spark, SF)
    stages.run_all(apps, inst, folder, trees=(2, 2, 2))
    losses = spark.read.parquet(f"{folder}/expected_loss")
    assert losses.count() == 1500 and losses.where("EXPECTED_LOSS < 0 or LGD not between 0.05 and 0.95").count() == 0
    notices = spark.read.json(f"{folder}/reports/adverse_action_notices")
    sizes = notices.selectExpr("max(size(Reasons))", "count(distinct get(Reasons, 0).RawFeatureName)").first()
    assert 2 <= sizes[0] <= 4 and sizes[1] > 1
    moves = spark.read.parquet(f"{folder}/counterfactual_actions")
    assert moves.count() > 0 and moves.where("new_pd >= 0.5 or original_pd <= 0.6").count() == 0
    hazard = PipelineModel.load(f"{folder}/models/hazard")
    assert hazard.transform(spark.read.parquet(f"{folder}/survival")).where("risk > 0").count() == 1500
    sides = spark.read.option("header", True).csv(f"{folder}/reports/concordance")
    assert {r["split"] for r in sides.collect()} == {"train", "test"}
    steps = spark.read.option("header", True).csv(f"{folder}/reports/cleaning")
    assert steps.where("step = 'median_fill' and value is not null and records > 0").count() == 3
    made = {p.name for p in (tmp_path / "out" / "reports").iterdir()}
    assert {"cleaning", "model_benchmark", "kaplan_meier", "hazard_ratios", "portfolio_summary", "stress_test"} <= made
    summary = spark.read.json(f"{folder}/reports/portfolio_summary").first()
    assert summary["total_loans"] == 1500
    assert spark.read.json(f"{folder}/reports/adverse_action_notices").count() == 1500
    assert spark.read.option("header", True).csv(f"{folder}/reports/model_benchmark").count() == 3
