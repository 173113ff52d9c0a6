import pytest

from tesselon.plans import run
from tesselon.schemas import SCORED, conform


def test_stage_list():
    assert run.stage_list(None) == list(run.STAGES) and run.stage_list(" Tumor, mask ") == ["tumor", "mask"]
    with pytest.raises(ValueError):
        run.stage_list("mask,nothing")


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("stride: 512\nqc: {focus_min: 7}\nmask: {od_percentile: 40, soft: true, expected: [0.1, 0.5]}\ntumor: {high: 0.9}\n")
    s = run.read_settings(str(tmp_path / "c.yaml"), "scale_balanced_v1")
    assert (s.stride, s.qc.focus_min, s.mask.od_percentile, s.mask.expected, s.tumor.high) == (512, 7, 40, (0.1, 0.5), 0.9)
    assert s.mask.soft is False  # the profile wins
    with pytest.raises(ValueError):
        run.settings({"nothing": 1})


def test_failures_are_kept_and_the_gate_may_fail(spark):
    def broken():
        raise OSError("gone")

    ran = []
    stages = {"mask": lambda: ran.append("mask"), "qc": broken, "gate": lambda: False, "tumor": lambda: ran.append("tumor")}
    code, rows = run.run_stages(spark, stages, run.stage_list("mask,qc,gate,tumor"))
    assert code == 2 and ran == ["mask", "tumor"] and [(r["stage"], r["code"]) for r in rows.collect()] == [("mask", 0), ("qc", 2), ("gate", 1), ("tumor", 0)]
    code, rows = run.run_stages(spark, stages, ["gate", "qc", "tumor"], go_on=False)
    assert code == 2 and rows.count() == 1
    assert run.run_stages(spark, stages, ["gate"])[0] == 0


def test_required_columns(spark):
    df = spark.createDataFrame([("a",)], "slide_uid string")
    with pytest.raises(ValueError, match="tumor_prob"):
        conform(df, SCORED, required=("tumor_prob",))
