"""Run configurations: files that extend each other, overrides, variables, and a snapshot with its digest."""

from __future__ import annotations

import hashlib
import json
import os
import re
from pathlib import Path
from typing import Any

VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def parsed(path: Path) -> dict[str, Any]:
    """A JSON file, or a YAML file where that library is there."""
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    import yaml

    return yaml.safe_load(text) or {}


def merged(base: Any, over: Any) -> Any:
    """Dictionaries key by key; anything else, lists too, is replaced."""
    if isinstance(base, dict) and isinstance(over, dict):
        return base | {k: merged(base[k], v) if k in base else v for k, v in over.items()}
    return over


def expanded(value: Any) -> Any:
    """With ${NAME} and ${NAME:-default} filled in from the environment; an error for a name that has neither."""
    if isinstance(value, dict):
        return {k: expanded(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v) for v in value]
    if not isinstance(value, str):
        return value

    def fill(m: re.Match) -> str:
        if (found := os.environ.get(m[1], m[2])) is None:
            raise KeyError(f"variable {m[1]} isn't set")
        return found

    return VARIABLE.sub(fill, value)


def load(path: str | Path, overrides: list[str] | None = None, seen: tuple[Path, ...] = ()) -> dict[str, Any]:
    """The file over those it extends, then the overrides `a.b=value` (values as JSON, else text), then variables."""
    path = Path(path).resolve()
    if path in seen:
        raise ValueError(f"files extend each other in a circle: {path}")
    own = parsed(path)
    bases = own.pop("extends", [])
    out: dict[str, Any] = {}
    for base in [bases] if isinstance(bases, str) else bases:
        out = merged(out, load(path.parent / base, seen=(*seen, path)))
    out = merged(out, own)
    for item in overrides or []:
        key, _, raw = item.partition("=")
        try:
            value = json.loads(raw)
        except ValueError:
            value = raw
        for part in reversed(key.split(".")):
            value = {part: value}
        out = merged(out, value)
    return out if seen else expanded(out)


def built(kind: type, values: dict[str, Any]):
    """A frozen configuration; an unknown key is an error."""
    names = set(kind.__dataclass_fields__)
    if unknown := set(values) - names:
        raise ValueError(f"{kind.__name__} has no {sorted(unknown)}")
    return kind(**values)


def snapshot(config: dict[str, Any]) -> tuple[str, str]:
    """The resolved configuration as JSON, and its sha256."""
    text = json.dumps(config, indent=2, sort_keys=True, ensure_ascii=False)
    return text, hashlib.sha256(text.encode()).hexdigest()
