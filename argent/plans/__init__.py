"""Model specs: one per silver table, built from the shared operators."""

from argent.plans.models import MODELS, SNAPSHOTS, ModelSpec, SnapshotSpec, build_silver, materialize

__all__ = ["MODELS", "SNAPSHOTS", "ModelSpec", "SnapshotSpec", "build_silver", "materialize"]
