"""The job CLI, run in-process (the session is shared through getOrCreate)."""

import json

from paths import SF001
from credit_signals.plans import jobs
from credit_signals.session import scratch_path
from credit_signals.sources import fixtures as fx


def test_cli_features_scoring_verify(spark, capsys):
    paths = fx.stage_inputs(spark, SF001)
    out, target = scratch_path(spark, "t-cli-f"), scratch_path(spark, "t-cli-s")
    assert jobs.main(["features", "--accounts", paths["accounts_table"], "--bureau", paths["bureau_table"],
                      "--out", out]) == 0
    fe = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (fe["total_accounts"], fe["high_risk_accounts"]) == (150, 78)
    assert jobs.main(["scoring", "--features", out, "--target", target, "--run-ts", "2001-11-05 12:00:00",
                      "--replace-days-only", "--auc", "grid"]) == 0
    sc = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sc["written_rows"] == 150 and sc["train_rows"] == 117
    assert jobs.main(["verify", "--features", out]) == 0
    ve = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert ve["low_risk_accounts"] == 72 and len(ve["sample"]) == 5


def test_public_api_names():
    import credit_signals as cs
    for name in cs.__all__:
        assert callable(getattr(cs, name)), name


def test_cli_smoke(spark, capsys):
    paths = fx.stage_inputs(spark, SF001)
    assert jobs.main(["smoke", "--accounts", paths["accounts"], "--rows", "3"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["row_count"] == 150 and len(out["columns"]) == 15 and len(out["first_rows"]) == 3
    assert [r["account_id"] for r in out["first_rows"]] == ["A000000000", "A000000001", "A000000002"]
