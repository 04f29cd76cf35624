"""Normalise flat text records into a relational model with Spark, and profile it.

``Load`` turns staging rows into dimensions, bridges and facts; ``card_profile``
reads them back as one row per card.  Everything is DataFrame work that Catalyst
plans; see README.md for the layout.
"""

from strandweave.plans.load import Load, load_batch
from strandweave.plans.model import Model, open_model
from strandweave.plans.profile import card_profile, identity_within
from strandweave.sources.store import SegmentStore
from strandweave.tables import Table, Workspace

__all__ = [
    "Load",
    "Model",
    "SegmentStore",
    "Table",
    "Workspace",
    "card_profile",
    "identity_within",
    "load_batch",
    "open_model",
]
