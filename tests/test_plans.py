import pytest
from pyspark.sql import functions as F

from tests.synthetic import slide
from tilewright.operators import overlays
from tilewright.plans import components, config
from tilewright.plans.config import Config, ConfigError
from tilewright.plans.report import slide_run


@pytest.mark.parametrize("bad", [
    {"tiles": {"size": -4}}, {"tiles": {"size": 2.5}}, {"tiles": {"drop_below": 1.5}}, {"tiles": {"outliers": -1}}, {"read": {"target_mpp": 0}}, {"read": {"target_mpp": float("nan")}},
    {"read": {"max_pixels": 0}}, {"read": {"target_mpp": None}}, {"normalization": {"method": "nope"}}, {"normalization": {"references": []}}, {"tissue": {"method": "x"}},
    {"artifacts": {"classes": []}}, {"artifacts": {"classes": ["fold", "fold"]}}, {"artifacts": {"classes": ["hole"]}}, {"artifacts": {"classes": [1]}}, {"artifacts": {"min_fraction": 2}},
    {"thresholds": {"m": {"min": 2, "max": 1}}}, {"thresholds": {"m": {"by_stain": {"HE": {"min": 2, "max": 1}}}}}, {"thresholds": {"m": {"by_stain": 3}}}, {"thresholds": {"m": {"min": True}}},
    {"thresholds": {"m": {"by_stain": {"HE": {"by_stain": {}}}}}}, {"checks": {"tolerance": -0.1}}, {"checks": {"enforced": ""}}, [], {"folds": None},
])
def test_values_outside_of_their_rules(bad):
    with pytest.raises(ConfigError):
        Config(bad)


def test_all_faults_at_once():
    assert len(config.faults({"nope": 1, "tiles": {"size": -4, "odd": 2}, "folds": {"lines": 1}})) == 4
    assert config.faults(config.DEFAULTS) == [] and set(config.RULES) == {f"{k}.{f}" if k not in config.RULES else k for k, v in config.DEFAULTS.items() for f in (v or [""])}


@pytest.mark.parametrize("bad", [{"nope": 1}, {"tiles": 3}, {"tiles": {"size": "x"}}, {"tiles": {"size": True}}, {"thresholds": {"m": {"min": "a"}}}, {"thresholds": {"m": {"least": 1}}}, {"folds": {"lines": 1}}, {"artifacts": {"classes": "fold"}}])
def test_malformed_layers(bad):
    with pytest.raises(ConfigError):
        Config(bad)


def test_layers_and_identity():
    c = Config({"tiles": {"drop_below": 0.2}}, {"tiles": {"size": 256}})  # the first layer says what the defaults say
    assert c.get("tiles.size") == 256 and c.get("tiles.outliers") == 10 and c.get("a.b", 7) == 7
    assert c.sha256 == Config({"tiles": {"size": 256}}).sha256 != Config().sha256
    t = Config({"thresholds": {"focus": {"min": 1, "max": None, "by_stain": {"HE": None}}, "x": None}})
    assert t.threshold_rows() == [("focus", None, 1, None), ("focus", "HE", None, None)]


def test_planning():
    p = components.plan()
    assert p.valid and p.run == list(components.ORDER)
    p = components.plan({"focus"})
    assert p.missing == {"focus": ["tissue_mask"]} and not p.valid
    p = components.plan({"focus"}, supplied={"tissue_mask", "tile_list"})
    assert p.valid and p.unused == ["tile_list"] and p.degraded == {"focus": ["fold_mask", "pen_mask"]}
    assert components.plan(None, supplied={"tissue_mask"}).skipped["tissue_segmentation"] == "supplied"
    with pytest.raises(ValueError):
        components.plan({"nothing"})


def test_a_run_of_three_slides(spark):
    rgb, t, _ = slide()
    h, w = t.shape
    rows = [(1, "HE", 0.5, 0.5, 20.0, h, w, bytearray(rgb.tobytes()), 8.0), (2, "HE", 0.5, 0.5, 20.0, h, w, bytearray(b"x"), 8.0), (3, "HE", 500.0, 500.0, None, h, w, bytearray(rgb.tobytes()), 8.0)]
    s = spark.createDataFrame(rows, "slide long, stain string, mpp_x double, mpp_y double, objective_power double, h int, w int, data binary, plane_mpp double")
    config = Config({"folds": {"lines": False}, "thresholds": {"tissue.coverage": {"min": 0.1, "max": 0.9}, "focus": {"min": 1e9}}})
    got = {r.slide: r for r in slide_run(s, config).collect()}
    assert got[1].tissue.coverage == pytest.approx(t.mean(), abs=0.02) and got[1].measures.focus > 0
    assert (got[1].verdict.n_evaluated, got[1].verdict.n_flags, got[1].verdict.passed) == (2, 1, False)
    assert got[2].tissue.error is not None and got[2].verdict.passed is None
    assert got[3].plane_gate == "no plausible scale" and got[3].tissue is None


def test_overlays():
    rgb, t, _ = slide()
    out = overlays.tinted(rgb, t, overlays.TINTS["fold"])
    assert (out[~t] == rgb[~t]).all() and (out[t] != rgb[t]).any()
    assert overlays.focus_overlay(rgb, [{"x": 0, "y": 0, "w": 9, "h": 9, "focus": 1.0}], (128, 96)) is rgb
    tiles = [{"x": 0, "y": 0, "w": 64, "h": 96, "focus": 1.0}, {"x": 64, "y": 0, "w": 64, "h": 96, "focus": 9.0}]
    heat = overlays.focus_overlay(rgb, tiles, (128, 96))
    assert heat[0, 0, 0] > heat[0, 127, 0]
    assert overlays.heat(0) == (255, 0, 0) and overlays.heat(1) == (0, 255, 0)


def test_entry_imports_without_optional_parts():
    import __spark_entry__ as e

    assert "tile_summary" in e.queries()


def test_gates_keep_pixels_unread(spark):
    from tilewright.operators import checks

    s = spark.createDataFrame([(1, 500.0, 500.0, None)], "slide int, mpp_x double, mpp_y double, objective_power double")
    assert checks.gates(checks.scale_check(s)).filter(F.col("plane_gate").isNull()).count() == 0
