"""The end-to-end example as an integration test."""

import importlib.util
import os

from conftest import SF_SMALL


def test_walkthrough(spark):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples", "walkthrough.py")
    spec = importlib.util.spec_from_file_location("walkthrough", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    out = mod.run(spark, SF_SMALL)
    assert out["generated"] == out["published"] == 2 * 20 and out["republished"] == 0
    assert out["train"] + out["test"] == 40 and out["test"] == 4 and out["sft_rows"] == 40
    assert set(out["mean_score_by_turn"]) <= {0, 1}
