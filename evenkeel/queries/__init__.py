"""Named queries over the test tables, each beside its SQL twin."""

from __future__ import annotations

from evenkeel.queries import labelling, learning, logs, rebalancing, scoring, training, vectorising, workflows
from evenkeel.queries.base import REGISTRY

__all__ = ["REGISTRY", "labelling", "learning", "logs", "rebalancing", "scoring", "training", "vectorising", "workflows"]
