"""Outside models in Python workers: each worker makes a model once and keeps it for later batches and tasks."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle

_LOADED: dict[bytes, Any] = {}


def loaded(load: Callable[[], Any]) -> Any:
    """What `load` makes, from this worker's table if it has made it before; equal functions share one model."""
    key = cloudpickle.dumps(load)
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]
