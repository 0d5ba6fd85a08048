"""Settings of a run: loading, precedence, validation, recipe digest. Driver-side and small."""

from __future__ import annotations

import copy
import json
import math
from collections.abc import Callable, Collection, Sequence
from pathlib import Path, PurePosixPath

from sievewright.functions.identity import digest
from sievewright.operators.ingest import ELIGIBLE
from sievewright.operators.integrity import CLASSES, SAMPLER


class ConfigError(ValueError):
    """A setting is missing or not allowed."""


def read_document(path: str | Path) -> dict:
    """JSON, or YAML where a YAML parser is installed."""
    text = Path(path).read_text()
    if str(path).endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ConfigError("YAML settings need PyYAML; JSON ones don't") from e
        return yaml.safe_load(text)
    return json.loads(text)


def lanes(value: str | Sequence[object], width: int = 2) -> list[list[str]]:
    """Worker ids ("4,5,6,7") as lanes of ``width``: unique whole numbers, as many as fill their lanes."""
    items = [str(x).strip() for x in (value.split(",") if isinstance(value, str) else value)]
    if not items or not all(x.isdigit() for x in items):
        raise ConfigError("workers: a list of whole numbers is needed")
    ids = [str(int(x)) for x in items]
    if len(set(ids)) < len(ids):
        raise ConfigError("workers: an id repeats")
    if len(ids) % width:
        raise ConfigError(f"workers: their number must be a multiple of {width}")
    return [ids[i : i + width] for i in range(0, len(ids), width)]


def merged(*layers: dict | None) -> dict:
    """Later layers win, section by section; values of None don't override."""
    out: dict = {}
    for layer in layers:
        for k, v in (layer or {}).items():
            if isinstance(v, dict):
                out[k] = merged(out.get(k), v)
            elif v is not None or k not in out:
                out[k] = v
    return out


def _whole(low: float, high: float = math.inf) -> Callable[[object], bool]:
    return lambda v: type(v) is int and low <= v <= high


def _number(low: float, high: float = math.inf, open_low: bool = False) -> Callable[[object], bool]:
    return lambda v: type(v) in (int, float) and math.isfinite(v) and (low < v if open_low else low <= v) and v <= high


def _is(value: object) -> Callable[[object], bool]:
    return lambda v: type(v) is type(value) and v == value


def _text(v: object) -> bool:
    return isinstance(v, str) and bool(v.strip())


def _optional(test: Callable[[object], bool]) -> Callable[[object], bool]:
    return lambda v: v is None or test(v)


def _relative(v: object) -> bool:
    return _text(v) and not PurePosixPath(v).is_absolute() and ".." not in PurePosixPath(v).parts


#: What each setting must be. Fixed values are those of the one supported workflow.
RULES: dict[str, Callable[[object], bool]] = {
    "schema_version": _is("2.0"),
    "run.seed": _whole(0, 2**32 - 1),
    "run.target_count": _optional(_whole(1)),
    "run.quota_scope": _is("total"),
    "run.strategy": _is("random_until_quota"),
    "run.limit_policy": _is("until_target_or_user_stop"),
    "run.max_attempts": lambda v: v is None,
    "run.max_wall_time_seconds": lambda v: v is None,
    "run.source_schedule": _is("round_robin"),
    "run.chain_augmentation": _is(False),
    "dataset.task": _is("image_only"),
    "dataset.image": _optional(_relative),
    "dataset.eligible_splits": lambda v: bool(v) and set(v) <= set(ELIGIBLE),
    "dataset.enforce_group_disjoint": _is(True),
    "dataset.enforce_cross_split_hash_disjoint": _is(True),
    "execution.max_technical_retries": _whole(0, 1),
    "execution.max_consecutive_technical_failures": _whole(1),
    "execution.worker_timeout_seconds": _number(0, open_low=True),
    "execution.retry_oom": _is(False),
    "execution.mode": _is("gpu_pairs_parallel"),
    "execution.candidate_concurrency": _is("auto"),
    "sampler.version": _is(SAMPLER),
    "sampler.operations": _is(["relocation"]),
    "sampler.geometry_attempts": _whole(1, 512),
    "accident_selection.method": _is("clip_contact_context_v1"),
    "accident_selection.context_padding": _number(0, 1),
    "verifier.backend": _is("clip_local"),
    "verifier.local_files_only": _is(True),
    "verifier.preprocessing": _is("letterbox_bicubic_gray_v1"),
    "verifier.model_revision": lambda v: isinstance(v, str) and len(v) == 40,
    "segmentation.backend": _is("torchvision_maskrcnn_resnet50_fpn"),
    "segmentation.weights_id": _is("COCO_V1"),
    "segmentation.class_ids": _is(list(CLASSES)),
    "segmentation.score_threshold": _number(0, 1, open_low=True),
    "segmentation.mask_threshold": _number(0, 1, open_low=True),
    "segmentation.min_area_pixels": _whole(1),
    "generation.source_prompt": _text,
    "generation.augmentation_prompt": _optional(_text),
    "storage.atomic_writes": _is(True),
    "storage.retain_rejected_details": _is(False),
    "storage.cleanup_existing": _is(True),
    "export.reject_fake_backend": _is(True),
    "export.deduplicate_exact_pixels": _is(True),
    "export.deduplicate_against_source": _is(True),
    "visualization.enabled": _is(True),
    "visualization.area_alpha": _number(0, 1),
    "visualization.max_panel_side_px": _whole(64),
}
#: Settings that may not be given.
FORBIDDEN = ("sampler.region_area_fraction", "sampler.expansion_pixels")
_ABSENT = object()


def _at(cfg: dict, path: str) -> object:
    for part in path.split("."):
        if not isinstance(cfg, dict) or part not in cfg:
            return _ABSENT
        cfg = cfg[part]
    return cfg


def problems(cfg: dict) -> list[str]:
    """Everything that is wrong with the settings."""
    found = [f"{path}: {'missing' if (v := _at(cfg, path)) is _ABSENT else f'not allowed: {v!r}'}" for path, good in RULES.items() if _at(cfg, path) is _ABSENT or not good(_at(cfg, path))]
    found += [f"{path}: not supported" for path in FORBIDDEN if _at(cfg, path) is not _ABSENT]
    found += [f"execution.{k}: workers choose no interpreter of their own" for k in cfg.get("execution", {}) if k.endswith("_python")]
    data, run = cfg.get("dataset", {}), cfg.get("run", {})
    if bool(data.get("input_dir")) == bool(data.get("manifest")):
        found.append("dataset: either input_dir or manifest is needed")
    if data.get("image") is not None and not data.get("input_dir"):
        found.append("dataset.image: needs input_dir")
    if run.get("output_root") and data.get("root"):
        out, root = Path(run["output_root"]).resolve(), Path(data["root"]).resolve()
        if out.is_relative_to(root) or root.is_relative_to(out):
            found.append("run.output_root: overlaps dataset.root")
    chosen = cfg.get("execution", {}).get("selected_gpu_ids")
    if chosen is not None:
        try:
            lanes(chosen)
        except ConfigError as e:
            found.append(str(e))
    return found


def generator_problems(params: dict, upstream: dict, allowed: Collection[str]) -> list[str]:
    """What is wrong with a generator's parameters: unknown names, numbers that aren't finite and not negative, step counts.

    Names that end with ``_num`` count steps: whole, at least 1 (0 for skipped ones), and fewer skipped than taken.
    """
    found = [f"{k}: not supported" for k in sorted(set(params) - set(allowed))]
    for key, value in params.items():
        if not _number(0)(value):
            found.append(f"{key}: not a finite number of at least 0")
        elif key.endswith("_num") and not _whole(0 if key == "skip_step_num" else 1)(value):
            found.append(f"{key}: not a step count")
    steps = {**upstream, **params}
    if not found and steps["skip_step_num"] >= min(steps["inversion_step_num"], steps["sampling_step_num"]):
        found.append("skip_step_num: not below inversion and sampling steps")
    return found


def selection_problems(asset: dict, method: str, stored_sha256: str) -> list[str]:
    """What is wrong with the captions that groups are selected by: version, rule, both kinds of view, texts, digest."""
    found = []
    if asset.get("version") != method:
        found.append("version: not that of the method")
    if asset.get("rule") != "both_views_involved_greater_than_uninvolved":
        found.append("rule: not supported")
    criteria = asset.get("criteria", {})
    if set(criteria) != {"single", "contact_group"} or not all(_text(c.get(side)) for c in criteria.values() for side in ("uninvolved", "involved")):
        found.append("criteria: two captions are needed for each kind of view")
    if digest(asset) != stored_sha256:
        found.append("digest: the captions have changed")
    return found


def load(path: str | Path, overrides: dict | None = None, defaults: dict | None = None) -> dict:
    """Overrides before the document before defaults; relative paths follow the document's folder."""
    cfg = merged(defaults, read_document(path), overrides)
    base = Path(path).resolve().parent
    for section, keys in {"run": ("output_root",), "dataset": ("root", "input_dir", "manifest")}.items():
        for key in keys:
            if isinstance(cfg.get(section, {}).get(key), str):
                cfg[section][key] = str((base / cfg[section][key]).resolve())
    if found := problems(cfg):
        raise ConfigError("; ".join(found))
    return cfg


def recipe_digest(cfg: dict) -> str:
    """Digest of what decides a run's results: everything but the choice of workers."""
    value = copy.deepcopy(cfg)
    value.get("execution", {}).pop("selected_gpu_ids", None)
    return digest(value)
