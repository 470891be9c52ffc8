"""Settings of a mirror run, with the values they have unless a file says otherwise."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.text import ACT_LABELS, JOINT_FORMATS


@dataclass(frozen=True)
class JointAct:
    register_act: str
    act_ref: str = ""
    statuses: tuple[str, ...] = ("Final",)


@dataclass(frozen=True)
class Config:
    joint_acts: dict[str, JointAct] = field(default_factory=dict)
    listing_act_ids: tuple[int, ...] = ()
    default_act_ref: str = ""
    require_status: str = ""
    max_pages: int = 600
    verify_after_days: int = 7
    daily_verify_budget: int = 600
    window_days: int = 14
    window_max: int = 250
    sweep_after_days: int = 31
    delay_seconds: float = 1.5
    act_labels: dict[str, str] = field(default_factory=lambda: dict(ACT_LABELS))
    joint_formats: dict[str, str] = field(default_factory=lambda: dict(JOINT_FORMATS))


def config_of(raw: dict) -> Config:
    """From a parsed settings file. Acts declared in it, by reference, add to the built-in names, or replace them."""
    inc, listing, acts = raw.get("incremental") or {}, raw.get("eba") or {}, raw.get("acts") or {}
    joint = {k: JointAct(v.get("register_act", k), v.get("act_ref", ""), tuple(v.get("statuses") or ("Final",))) for k, v in (raw.get("joint_acts") or {}).items()}
    labels = {str(ref): str(v["label"]) for ref, v in acts.items() if v.get("label")}
    formats = {str(v.get("token") or v.get("label") or ref).upper(): str(v["joint_id_format"]) for ref, v in acts.items() if v.get("joint_id_format")}
    return Config(
        joint, tuple(listing.get("legal_act_ids") or ()), listing.get("default_act_ref", ""), listing.get("require_status", ""), listing.get("max_pages", 600),
        inc.get("verify_after_days", 7), inc.get("daily_verify_budget", 600), inc.get("window_days", 14), inc.get("window_max", 250), inc.get("sweep_after_days", 31), float(raw.get("delay_seconds", 1.5)),
        ACT_LABELS | labels, JOINT_FORMATS | formats,
    )


def read_config(path: str) -> Config:
    """A YAML file, where the yaml library is installed, or a JSON one."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        return config_of(yaml.safe_load(text) or {})
    except ImportError:
        import json

        return config_of(json.loads(text))
