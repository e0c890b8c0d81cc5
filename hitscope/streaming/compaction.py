"""Folding closed batches of a changelog: a base folder and a manifest that names it.

``_manifest/<n>`` says which folder holds the fold of the batches up to *n*. The
greatest *n* counts; a base that no manifest names was left by a fold that
was killed, and is not read.
"""

import json
from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from hitscope.streaming.folders import Folder

BATCH = "batch_id="
_MANIFEST, _BASE = "_manifest", "_base"


def batches_in(folder: Folder) -> list[int]:
    return sorted(int(name.removeprefix(BATCH)) for name in folder.names() if name.startswith(BATCH))


def manifest(folder: Folder) -> dict | None:
    """``up_to, base`` of the last fold, with ``replaced`` of the one before."""
    folds = [int(name) for name in folder.names(_MANIFEST) if name.isdigit()]
    return json.loads(folder.read(f"{_MANIFEST}/{max(folds)}")) if folds else None


def fold_batches(
    folder: Folder,
    read: Callable[[], DataFrame],
    write: Callable[[DataFrame, str], None],
    keys: Sequence[str],
    up_to: int | None,
) -> int | None:
    batches, before = batches_in(folder), manifest(folder)
    if up_to is None:
        up_to = max(batches, default=0) - 1
    elif up_to >= max(batches, default=0):
        raise ValueError(f"batch {up_to} is not closed: only those before the last one are")
    done = -1 if before is None else before["up_to"]
    if up_to <= done:
        return None if before is None else done
    changelog = read().where(F.col("batch_id") <= up_to)
    values = [c for c in changelog.columns if c not in (*keys, "batch_id")]
    last = [F.max_by(c, "batch_id").alias(c) for c in values]
    base = f"{_BASE}/{up_to}-{uuid4().hex}"
    write(changelog.groupBy(*keys).agg(*last, F.max("batch_id").alias("batch_id")), base)
    folder.write_once(f"{_MANIFEST}/{up_to}", json.dumps({"up_to": up_to, "base": base, "replaced": done}))
    _remove_replaced(folder, before, base)
    return up_to


def _remove_replaced(folder: Folder, before: dict | None, base: str) -> None:
    """What the manifest before this one had replaced already, and bases that none of both names."""
    kept = [base] if before is None else [base, before["base"]]
    for name in folder.names(_BASE):
        if f"{_BASE}/{name}" not in kept:
            folder.remove(f"{_BASE}/{name}")
    if before is None:
        return
    for n in batches_in(folder):
        if n <= before["up_to"]:
            folder.remove(f"{BATCH}{n}")
    for name in folder.names(_MANIFEST):
        if name.isdigit() and int(name) < before["up_to"]:
            folder.remove(f"{_MANIFEST}/{name}")
