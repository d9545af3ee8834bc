"""Deleting old partitions and whole layers, under guards; nothing goes without `apply`."""

from __future__ import annotations

import os
import re
import shutil
from datetime import date

LAYERS = ("bronze", "silver", "gold")


def guarded(root: str, path: str) -> str:
    """The real path, which must lie below a real, not too shallow, root."""
    root, path = os.path.realpath(root), os.path.realpath(path)
    if root.count(os.sep) < 2 or root in (os.path.expanduser("~"), os.sep):
        raise ValueError(f"refusing to work on {root}")
    if os.path.commonpath([root, path]) != root or path == root:
        raise ValueError(f"{path} lies outside {root}")
    return path


def _end(parts: str) -> date | None:
    """The last day that a partition folder may hold, from its name."""
    hive = re.search(r"year=(\d+)(?:/month=(\d+))?(?:/[a-z_]+=(\d{4}-\d{2}-\d{2}))?$", parts)
    plain = re.search(r"/(\d{4})/(\d{2})/(\d{2})$", parts)
    if plain:
        return date(*map(int, plain.groups()))
    if not hive:
        return None
    if hive[3]:
        return date.fromisoformat(hive[3])
    year, month = int(hive[1]), int(hive[2] or 12)
    first = date(year + month // 12, month % 12 + 1, 1)
    return date.fromordinal(first.toordinal() - 1)


def prune(root: str, before: date, layers: tuple[str, ...] = ("bronze",), apply: bool = False) -> list[str]:
    """Partition folders that end strictly before a day; deleted only with `apply`."""
    found: list[str] = []
    for layer in layers:
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer}")
        for folder, names, _ in os.walk(os.path.join(root, layer)):
            for name in list(names):
                path = os.path.join(folder, name)
                end = _end(path)
                if end is not None and end < before and not os.path.islink(path):
                    found.append(path)
                    names.remove(name)
    if apply:
        for path in found:
            shutil.rmtree(guarded(root, path))
    return sorted(found)


def sweep_orphans(root: str, max_age_seconds: float = 86_400, now: float | None = None, apply: bool = False) -> list[str]:
    """Files that a writer outside of Spark left under a reserved name, older than a day; links aren't followed."""
    import time

    from ..sources.tables import RESERVED

    found, limit = [], (time.time() if now is None else now) - max_age_seconds
    for layer in ("silver", "gold"):
        for folder, _, names in os.walk(os.path.join(root, layer)):
            for path in (os.path.join(folder, n) for n in names if RESERVED.search(n)):
                if not os.path.islink(path) and os.stat(path).st_mtime < limit:
                    found.append(path)
    if apply:
        for path in found:
            os.remove(guarded(root, path))
    return sorted(found)


def reset(root: str, layers: tuple[str, ...] = (), datasets: tuple[str, ...] = (), apply: bool = False) -> list[str]:
    """Layers, or `source/dataset` folders in every layer."""
    wanted = [os.path.join(root, x) for x in layers] if not datasets else [os.path.join(root, x, d) for x in (layers or LAYERS) for d in datasets]
    found = [p for p in wanted if os.path.isdir(p)]
    for path in found:
        guarded(root, path)
        if apply:
            shutil.rmtree(path)
    return found
