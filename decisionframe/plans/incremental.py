"""Stages that run again only when their own settings or what they read has changed. All of it is on the driver."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from ..sources.sinks import read_json, write_json


@dataclass
class Stage:
    name: str
    run: Callable[[], object]
    keys: tuple[str, ...] = ()
    after: tuple[str, ...] = ()
    extra: Callable[[], object] | None = None


def short_hash(value: object) -> str:
    return hashlib.sha1(json.dumps(value, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()[:12]


def stage_hashes(stages: list[Stage], config: dict[str, object], late: dict[str, object] | None = None) -> dict[str, str]:
    """A hash for each stage over its own settings, what extra() adds and the hashes of the stages before it. Settings that
    still have their late default count as absent, so old results stay valid when a setting is added."""
    out: dict[str, str] = {}
    for s in stages:
        own = {k: config[k] for k in s.keys if k in config and not (late and k in late and config[k] == late[k])}
        out[s.name] = short_hash([own, [out[a] for a in s.after], s.extra() if s.extra else None])
    return out


class Manifest:
    def __init__(self, path: str | Path) -> None:
        self.path, self.rows = path, read_json(path, {}) or {}

    def stale(self, name: str, hash_: str) -> str:
        """Why the stage must run, or ''."""
        row = self.rows.get(name)
        return "never run" if not row else f"status {row['status']}" if row["status"] != "done" else "inputs changed" if row["hash"] != hash_ else ""

    def set(self, name: str, status: str, hash_: str, **more: object) -> None:
        self.rows[name] = {"status": status, "hash": hash_, "when": time.strftime("%Y-%m-%dT%H:%M:%S"), **more}
        write_json(self.path, self.rows)

    def overview(self, hashes: dict[str, str]) -> dict[str, str]:
        return {n: ("stale" if self.rows.get(n, {}).get("status") == "done" and self.stale(n, h) else self.rows.get(n, {}).get("status", "never run")) for n, h in hashes.items()}


def run_stages(stages: list[Stage], config: dict[str, object], manifest: Manifest, first: str | None = None, last: str | None = None, force: bool = False) -> list[str]:
    """Run the stale stages from first to last, in order; the names of those that ran."""
    names = [s.name for s in stages]
    a, b = names.index(first) if first else 0, names.index(last) if last else len(names) - 1
    ran = []
    for s in stages[a : b + 1]:
        # hashes are taken anew: a stage may have changed what the next one's extra() reads
        h = stage_hashes(stages, config)[s.name]
        if not force and not manifest.stale(s.name, h):
            continue
        manifest.set(s.name, "running", h)
        try:
            s.run()
        except BaseException as e:
            manifest.set(s.name, "failed" if isinstance(e, Exception) else "stopped", h, error=str(e)[:500])
            raise
        manifest.set(s.name, "done", h)
        ran.append(s.name)
    return ran


class Registry:
    """Trained artefacts: add, promote, resolve by unique part of the name, prune."""

    def __init__(self, path: str | Path) -> None:
        self.path, self.rows = path, read_json(path, {}) or {}

    def add(self, name: str, **info: object) -> None:
        self.rows[name] = {**self.rows.get(name, {}), **info}
        write_json(self.path, self.rows)

    def promote(self, name: str) -> None:
        for k, row in self.rows.items():
            row["latest"] = k == name
        write_json(self.path, self.rows)

    def resolve(self, part: str = "") -> str:
        if not part:
            found = [k for k, r in self.rows.items() if r.get("latest")] or sorted(self.rows)[-1:]
        else:
            found = [part] if part in self.rows else [k for k in self.rows if part in k]
        if len(found) != 1:
            raise KeyError(f"{part!r} names {len(found)} artefacts")
        return found[0]

    def prune(self, keep: int) -> list[str]:
        gone = [k for k in sorted(self.rows)[:-keep or None] if not self.rows[k].get("latest")] if keep < len(self.rows) else []
        for k in gone:
            del self.rows[k]
        write_json(self.path, self.rows)
        return gone


def typed(config: dict[str, object], changes: dict[str, str]) -> dict[str, object]:
    """config with changes given as text, each read as its setting's type; an unknown setting raises."""
    out = dict(config)
    for k, v in changes.items():
        if k not in config:
            raise KeyError(k)
        old = config[k]
        out[k] = v.lower() in ("1", "true", "yes", "on") if isinstance(old, bool) else type(old)(v) if isinstance(old, int | float | str) else json.loads(v)
    return out
