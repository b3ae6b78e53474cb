"""Configuration on the driver: files, switches, scenarios and person lists. Nothing here touches data."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from ..functions.rules import RULES
from ..operators.quality import checked_weights


def load(path: str) -> dict:
    """A YAML (where a parser is installed) or JSON mapping."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        found = json.loads(text)
    else:
        found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} does not hold a mapping")
    return found


def env_file(path: str, environment: dict[str, str]) -> dict[str, str]:
    """Variables of an env file that ``environment`` doesn't have; ``export``, quotes and comments are understood."""
    out: dict[str, str] = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines() if os.path.exists(path) else []:
        found = re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line)
        if found and found[1] not in environment and found[1] not in out:
            value = found[2]
            out[found[1]] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def rule_switches(raw: dict | None) -> dict[str, bool]:
    """All rules with their switches; an unknown rule or a value that isn't a boolean raises."""
    unknown = sorted(set(raw or {}) - set(RULES))
    if unknown:
        raise ValueError(f"unknown rules: {', '.join(unknown)}")
    wrong = [k for k, v in (raw or {}).items() if not isinstance(v, bool)]
    if wrong:
        raise ValueError(f"rule switches must be booleans: {', '.join(wrong)}")
    return {name: (raw or {}).get(name, True) for name in RULES}


def scoring(raw: dict | None) -> dict[str, int]:
    return checked_weights(raw)


def version(text: str) -> str:
    if not re.fullmatch(r"\d+\.\d+\.\d+", text.strip()):
        raise ValueError(f"not a version: {text!r}")
    return text.strip()


def auto_paths(payload, at: str = "") -> list[str]:
    """Dotted paths of the values ``auto``."""
    if isinstance(payload, dict):
        return [p for k, v in payload.items() for p in auto_paths(v, f"{at}.{k}" if at else str(k))]
    if isinstance(payload, list):
        return [p for i, v in enumerate(payload) for p in auto_paths(v, f"{at}[{i}]")]
    return [at] if payload == "auto" else []


def fill(value, context: dict[str, str]):
    """``{key}`` filled in all strings of nested lists and mappings; unknown keys stay."""
    if isinstance(value, str):
        return re.sub(r"\{(\w+)\}", lambda m: str(context.get(m[1], m[0])), value)
    if isinstance(value, list):
        return [fill(v, context) for v in value]
    if isinstance(value, dict):
        return {k: fill(v, context) for k, v in value.items()}
    return value


def resize(specs: list[dict], size: int, default: dict) -> list[dict]:
    """The first ``size`` specifications, filled up with copies of the default."""
    return specs[:size] + [dict(default) for _ in range(size - len(specs))]


def choose_scenario(value: str | None, options: dict[str, str], default: str | None = None) -> str:
    """A scenario by its key, or by key or label in any case; else the default, else the first."""
    if value in options:
        return value
    folded = (value or "").casefold().strip()
    for key, label in options.items():
        if folded and folded in (key.casefold(), label.casefold()):
            return key
    if default in options:
        return default
    if not options:
        raise ValueError("no scenarios")
    return next(iter(options))


def enum_names(values: list[str]) -> dict[str, str]:
    """Identifier for each value; repeated ones get a number."""
    out: dict[str, str] = {}
    for value in values:
        name = re.sub(r"\W+", "_", value).strip("_").upper() or "VALUE"
        name = f"_{name}" if name[0].isdigit() else name
        free, n = name, 2
        while free in out:
            free, n = f"{name}_{n}", n + 1
        out[free] = value
    return out
