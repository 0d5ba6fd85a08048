"""Settings, command line, files on the driver, nested JSON, pixels, streaming."""

from __future__ import annotations

import copy
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright import cli, config
from sievewright.functions import nested, pixels
from sievewright.operators import integrity, lifecycle
from sievewright.streaming.quota import windowed_outcomes

GOOD = {
    "schema_version": "2.0",
    "run": {"seed": 42, "output_root": "/o", "target_count": None, "quota_scope": "total", "strategy": "random_until_quota", "limit_policy": "until_target_or_user_stop", "max_attempts": None, "max_wall_time_seconds": None, "source_schedule": "round_robin", "chain_augmentation": False},
    "dataset": {"root": "/i", "input_dir": "/i", "image": None, "manifest": None, "task": "image_only", "eligible_splits": ["source"], "enforce_group_disjoint": True, "enforce_cross_split_hash_disjoint": True},
    "execution": {"max_technical_retries": 1, "max_consecutive_technical_failures": 3, "worker_timeout_seconds": 10, "retry_oom": False, "selected_gpu_ids": "4,5", "mode": "gpu_pairs_parallel", "candidate_concurrency": "auto"},
    "sampler": {"version": "accident_group_v1", "operations": ["relocation"], "geometry_attempts": 64},
    "accident_selection": {"method": "clip_contact_context_v1", "context_padding": 0.25},
    "verifier": {"backend": "clip_local", "local_files_only": True, "preprocessing": "letterbox_bicubic_gray_v1", "model_revision": "0" * 40},
    "segmentation": {"backend": "torchvision_maskrcnn_resnet50_fpn", "weights_id": "COCO_V1", "class_ids": [3, 4, 6, 8], "score_threshold": 0.5, "mask_threshold": 0.5, "min_area_pixels": 32},
    "generation": {"source_prompt": "a scene", "augmentation_prompt": None},
    "storage": {"atomic_writes": True, "retain_rejected_details": False, "cleanup_existing": True},
    "export": {"reject_fake_backend": True, "deduplicate_exact_pixels": True, "deduplicate_against_source": True},
    "visualization": {"enabled": True, "area_alpha": 0.25, "max_panel_side_px": 1024},
}


def changed(path, value):
    cfg = copy.deepcopy(GOOD)
    section, key = path.split(".")
    cfg[section][key] = value
    return cfg


def test_settings():
    assert config.problems(GOOD) == []
    bad = [("verifier.local_files_only", False), ("verifier.model_revision", "main"), ("segmentation.weights_id", "V2"), ("execution.mode", "serial"), ("execution.worker_python", "/x"), ("accident_selection.method", "other")]
    bad += [("run.seed", -1), ("run.seed", True), ("run.max_attempts", 5), ("run.target_count", 0), ("run.output_root", "/i/out"), ("dataset.eligible_splits", ["val"]), ("dataset.eligible_splits", []), ("dataset.image", "../x"), ("dataset.manifest", "m"), ("dataset.input_dir", None), ("execution.max_technical_retries", 2), ("execution.worker_timeout_seconds", float("nan")), ("execution.selected_gpu_ids", "1"), ("sampler.geometry_attempts", 0), ("sampler.expansion_pixels", 3), ("segmentation.score_threshold", 0), ("generation.augmentation_prompt", " "), ("storage.retain_rejected_details", True)]
    for path, value in bad:
        assert config.problems(changed(path, value)), path
    assert config.recipe_digest(changed("execution.selected_gpu_ids", "0,1")) == config.recipe_digest(GOOD) != config.recipe_digest(changed("run.seed", 1))
    assert config.lanes("4, 5,6,7") == [["4", "5"], ["6", "7"]]
    for wrong in ("", "1", "1,1", "a,b", "1,2,3"):
        with pytest.raises(config.ConfigError):
            config.lanes(wrong)


def test_selection_captions():
    asset = {"version": "m", "rule": "both_views_involved_greater_than_uninvolved", "criteria": {k: {"uninvolved": "a", "involved": "b"} for k in ("single", "contact_group")}}
    sha = config.digest(asset)
    assert config.selection_problems(asset, "m", sha) == []
    assert [p.split(":")[0] for p in config.selection_problems({**asset, "rule": "any"}, "n", sha)] == ["version", "rule", "digest"]
    blank = {**asset, "criteria": {**asset["criteria"], "single": {"uninvolved": " ", "involved": "b"}}}
    assert [p.split(":")[0] for p in config.selection_problems(blank, "m", config.digest(blank))] == ["criteria"]


def test_precedence(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps(GOOD))
    assert config.load(path, {"run": {"target_count": 7}})["run"]["target_count"] == 7
    assert config.load(path, {"run": {"seed": None}})["run"]["seed"] == 42
    with pytest.raises(config.ConfigError):
        config.load(path, {"run": {"seed": 2**32}})


def test_command_line(capsys, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps(GOOD))
    assert cli.main(["plan", "5", "--target-count", "5", "--config", str(path)]) == 2
    assert cli.main(["plan", "--resume", "--prompt", "x", "--config", str(path)]) == 2
    assert cli.main(["plan", "--workers", "1", "--config", str(path)]) == 2
    assert cli.main(["report", str(tmp_path / "none")]) == 1
    with pytest.raises(SystemExit) as e:
        cli.main(["plan", "0", "--config", str(path)])
    assert e.value.code == 2


def test_removal_is_checked_journaled_and_resumed(tmp_path):
    root, journals = tmp_path / "run", tmp_path / "cleanup"
    (root / "candidates/a").mkdir(parents=True)
    journals.mkdir()
    (root / "candidates/a/x.png").write_text("x")
    (root / "keep").write_text("k")
    journal = journals / "a.json"
    with pytest.raises(lifecycle.Blocked):
        lifecycle.remove_planned(root, "a", ["candidates/a"], ["candidates/a/x.png"], journal)
    with pytest.raises(lifecycle.Blocked):
        lifecycle.remove_planned(root, "a", ["../x"], [], journal)
    os.link(root / "keep", root / "candidates/a/hard")
    with pytest.raises(lifecycle.Blocked):
        lifecycle.remove_planned(root, "a", ["candidates/a"], [], journal)
    (root / "candidates/a/hard").unlink()
    (root / "candidates/a/link").symlink_to(root / "keep")
    with pytest.raises(lifecycle.Blocked):
        lifecycle.remove_planned(root, "a", ["candidates/a"], [], journal)
    (root / "candidates/a/link").unlink()
    assert not journal.exists() and (root / "candidates/a/x.png").exists()
    journal.write_text(json.dumps({"candidate_id": "a", "state": "pending", "paths": ["candidates/a"]}))
    assert lifecycle.recover_removals(root, journals, []) == ["a"]
    assert not (root / "candidates/a").exists() and (root / "keep").exists()
    assert lifecycle.recover_removals(root, journals, []) == []
    with lifecycle.writer_lock(tmp_path / "lock"), pytest.raises(BlockingIOError), lifecycle.writer_lock(tmp_path / "lock"):
        pass


def test_nested_json():
    doc = {"a": "runs/1/x", "b": ["runs/1", {"runs/1": "runs/12"}], "c": 3}
    assert nested.leaves(doc) == ["runs/1/x", "runs/1", "runs/12"]
    for text in ('{"a":1,"a":2}', '{"a":NaN}', "{"):
        with pytest.raises(ValueError):
            nested.strict_json(text)


def test_resume_stage_and_cursor(spark):
    rows = spark.createDataFrame([(s,) for s in lifecycle.STATUSES], "status string")
    assert [r[0] for r in rows.select(lifecycle.resume_stage(F.col("status"))).collect()] == [*lifecycle.STATUSES[1:], None]
    entries = spark.createDataFrame([("a", 0, 0), ("b", 0, 1), ("a", 1, 2)], "source_id string, attempt_index long, sequence long")
    pending = spark.createDataFrame([("a", 2, 3)], "source_id string, attempt_index long, sequence long")
    assert {r["source_id"]: r["next_attempt"] for r in lifecycle.cursor(entries, pending).collect()} == {"a": 3, "b": 1}


def test_criteria_and_resume_errors():
    pairs = [{"id": i + 1, "undesired": f"u{i}", "preferred": f"p{i}"} for i in range(5)]
    good = {"policy": {"least": 3}, "pairs": pairs}
    assert integrity.criteria_errors(good, {"least": 3}) == []
    assert integrity.criteria_errors({**good, "pairs": pairs[::-1]}, {"least": 4}) == ["policy: least", "ids"]
    assert integrity.criteria_errors({**good, "pairs": [*pairs[:4], {**pairs[4], "preferred": "u0"}]}, {}) == ["captions"]
    assert integrity.resume_errors({"backend": "x"}, {"backend": "y"}) == ["backend"]


def test_pixels():
    rng = np.random.default_rng(1)
    frame, mask = rng.integers(0, 256, (20, 30, 3), dtype=np.uint8), np.zeros((20, 30), dtype=bool)
    mask[5:9, 10:20] = True
    assert (pixels.cutout(frame, mask)[~mask] == pixels.GRAY).all() and (pixels.cutout(frame, mask)[mask] == frame[mask]).all()
    assert pixels.padded_crop(frame, mask, 0.25).shape == (6, 16, 3)
    boxed = pixels.letterbox(np.full((10, 40, 3), 200, dtype=np.uint8), 32)
    assert boxed.shape == (32, 32, 3) and (boxed[:12] == pixels.GRAY).all() and (boxed[13:19] == 200).all()
    assert (pixels.bicubic(frame, 20, 30) == frame).all()
    assert pixels.arrow((0, 0), (500, 0), (100, 50))[1] == (99.0, 0.0)


def test_event_time_windows(spark):
    rows = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "a", 3.0)], "ts string, event_type string, value double")
    assert sorted(r["n"] for r in windowed_outcomes(rows).collect()) == [1, 2]
