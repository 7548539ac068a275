"""Run settings: JSON with comments, deep merges, and what overrides what."""

from __future__ import annotations

import json
from dataclasses import replace
from typing import Any

from vistaloom.operators.pairs import PairConfig, TaskGate

#: Settings of stages and of named runs, which override stages key by key; what skills ask of a pair.
SAMPLING: dict[str, Any] = {"sampling": "stride", "limit_frames": 0, "min_translation_m": 0.20, "min_rotation_deg": 15.0, "frame_stride": 50, "min_keyframes": 30, "cosmic_base_sampling": "stride", "cosmic_union_coverage_min": 0.3, "cosmic_yaw_diff_min_deg": 30.0}
STAGES: dict[str, dict[str, Any]] = {
    "sample": SAMPLING,
    "pair_gate": {**SAMPLING, "cosmic_obj_vis_area_min": 0.005, "cosmic_obj_vis_depth_pix_min": 50},
    "filter": {"model": "qwen3vl-235B", "vllm_concurrency": None, "n_votes": 1, "vote_temperature": 0.7},
    "label": {"model": "qwen3vl-235B", "prompt_file": None, "vllm_concurrency": None, "n_votes": 1, "vote_temperature": 0.7},
    "perceive": {"detector": "scannet-gt", "segmenter": "gt-mask", "gdino_max_classes": 200, "labeler": "qwen3vl-235B", "prompt_file": None, "cache_root": "cache/perception", "workers": None, "batch_frames": 48, "prepass_min_frames": 40, "compile_perception": False, "n_votes": 1, "vote_temperature": 0.7, "vote_strategy": "union"},
    "match": {"detector": "scannet-gt", "segmenter": "gt-mask", "gdino_max_classes": 200, "labeler": "qwen3vl-235B", "prompt_file": None, "cache_root": "cache/perception", "seed": 42, "seed_retries": 5, "depth_tol": 0.15, "iou_min": 0.20, "voxel_dedup": 0.05, "emit_occlusion_negatives": True, "max_samples_per_scene": 200, "max_det_per_frame": 15},
    "verify": {"model": "qwen3vl-235B-pair", "verify_concurrency": None, "write_verified": True},
}
ADAPTIVE = {"sample": {"sampling": "adaptive"}, "pair_gate": {"sampling": "adaptive"}}
OPEN = {"detector": "labeled-gdino", "segmenter": "sam2.1"}
BATCHED = {**OPEN, "batch_frames": 4, "prepass_min_frames": 40}
RUNS: dict[str, dict[str, dict[str, Any]]] = {
    "default": {**ADAPTIVE, "filter": {"model": "qwen3vl-235B"}, "label": {"model": "qwen3vl-235B"}, "perceive": OPEN, "match": OPEN, "verify": {"model": "qwen3vl-235B-pair"}},
    "cpu_smoke": {"perceive": {"detector": "noop", "segmenter": "noop"}, "match": {"detector": "noop", "segmenter": "noop"}},
    "qwen3vl_default": {**ADAPTIVE, "filter": {"model": "qwen3vl-235B", "vllm_concurrency": 8}, "label": {"model": "qwen3vl-235B", "vllm_concurrency": 8}, "perceive": BATCHED, "match": OPEN},
    "qwen3vl_vote3": {
        **ADAPTIVE, "filter": {"model": "qwen3vl-235B", "vllm_concurrency": 8}, "label": {"model": "qwen3vl-235B", "vllm_concurrency": 8, "n_votes": 3, "vote_temperature": 0.7},
        "perceive": {**BATCHED, "n_votes": 3, "vote_temperature": 0.7, "vote_strategy": "per-run-detect"}, "match": OPEN,
    },
}
SKILLS: dict[str, dict[str, Any]] = {
    "anchor": {"overlap": (0.25, 0.70), "least": 1, "low": 0.5, "high": 2.0, "rotation": 35.0, "translation": 0.6},
    "counting": {"overlap": (0.15, 0.60), "low": 3, "high": 15},
    "cross_depth_variation": {"ratio": 1.3, "delta": 0.5},
    "cross_object_correspondence": {"overlap": (0.15, 0.30), "least": 1, "score": 0.25, "share": 0.005},
    "cross_occlusion_visibility": {"overlap": 0.40, "occluded": 0.15},
    "cross_point_correspondence": {"overlap": (0.15, 0.30), "least": 1, "score": 0.25, "coverage": 0.6},
    "cross_spatial_transformation": {"rotation": 30.0, "low": 0.6, "high": 1.67},
    "relative_direction": {"overlap": (0.05, 0.40), "translation": 1.0, "rotation": 20.0, "elevation": 60.0, "apart": 30.0},
    "relative_distance": {"overlap": (0.20, 0.70), "objects": 3, "margin": 0.5, "coverage": 0.6},
}


def without_comments(x: Any) -> Any:
    """x without keys that begin with an underscore, at any depth."""
    if isinstance(x, dict):
        return {k: without_comments(v) for k, v in x.items() if not k.startswith("_")}
    return [without_comments(v) for v in x] if isinstance(x, list) else x


def merged(base: dict, over: dict) -> dict:
    """base with over's values: dicts merge, all else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(text: str) -> dict:
    return without_comments(json.loads(text))


def prompt_text(text: str, name: str) -> str:
    """A prompt file's text: the body, or what a JSON file has under `prompt`."""
    return json.loads(text)["prompt"] if name.endswith(".json") else text


def stage(name: str, run: str | None = None, overrides: dict[str, Any] | None = None) -> dict[str, Any]:
    """A stage's settings: its own, then those of a named run, then those given that aren't None."""
    if name not in STAGES:
        raise KeyError(f"no stage {name!r}")
    if run is not None and run not in RUNS:
        raise KeyError(f"no run {run!r}")
    given = {k: v for k, v in (overrides or {}).items() if v is not None}
    if unknown := given.keys() - STAGES[name].keys():
        raise KeyError(f"{name} has no {sorted(unknown)}")
    return merged(merged(STAGES[name], RUNS[run].get(name, {}) if run else {}), given)


def pair_config(source: str, overrides: dict[str, Any] | None = None) -> PairConfig:
    """Pair selection for a source; overrides name fields of PairConfig, tasks as dicts of TaskGate's."""
    values = dict(overrides or {})
    if "tasks" in values:
        values["tasks"] = {n: TaskGate(**g) for n, g in values["tasks"].items()}
    return replace(PairConfig(source=source), **values)
