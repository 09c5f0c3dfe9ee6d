"""Configuration: YAML or JSON mappings, dotted access, checks that name every problem at once."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from sparkloom.operators.validation import CATEGORIES


class ConfigError(ValueError):
    """A configuration that can't be used."""


def load(path: str | Path) -> dict[str, Any]:
    """The mapping in a file; anything else at its root is an error."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        value = json.loads(text)
    else:
        import yaml

        value = yaml.safe_load(text)
    if not isinstance(value, dict):
        raise ConfigError(f"{path}: the root must be a mapping")
    return value


def dotted(value: Mapping[str, Any], name: str) -> Any:
    for part in name.split("."):
        if not isinstance(value, Mapping) or part not in value:
            raise ConfigError(f"missing setting {name}")
        value = value[part]
    return value


def cleaning_problems(c: Mapping[str, Any]) -> list[str]:
    out = []
    length = c.get("length", {})
    if not 0 <= length.get("min_chars", -1) < length.get("max_chars", -1):
        out.append("length: min_chars must be below max_chars")
    if not 0 <= c.get("language", {}).get("min_probability", -1) <= 1:
        out.append("language.min_probability must lie in 0 to 1")
    for kind, pattern in c.get("pii", {}).get("patterns", {}).items():
        try:
            re.compile(pattern)
        except re.error as e:
            out.append(f"pii.patterns.{kind}: {e}")
    return out


def split_problems(c: Mapping[str, Any]) -> list[str]:
    out = []
    ratios = c.get("ratios", {})
    parts = [ratios.get(k, 0) for k in ("train", "validation", "test")]
    if abs(sum(parts) - 1) > 1e-9 or min(parts) <= 0:
        out.append("ratios must be positive and add up to 1")
    if {*c.get("required_categories", CATEGORIES)} - {*CATEGORIES}:
        out.append("required_categories has unknown categories")
    if sum(c.get("minimum_fractions", {}).values()) > 1:
        out.append("minimum_fractions add up to more than 1")
    return out


def source_problems(sources: Mapping[str, Mapping[str, Any]], kinds: Mapping[str, Any]) -> list[str]:
    out = []
    for name, s in sources.items():
        if s.get("kind") not in kinds:
            out.append(f"{name}: unknown kind {s.get('kind')}")
        if s.get("category") not in (*CATEGORIES, None):
            out.append(f"{name}: unknown category {s['category']}")
        if s.get("tier") not in (1, 2, 3, "quarantine"):
            out.append(f"{name}: unknown tier {s.get('tier')}")
    return out


def require(problems: list[str]) -> None:
    if problems:
        raise ConfigError("; ".join(problems))
