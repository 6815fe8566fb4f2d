"""Every query of the library by name, with its SQL where SQL can express it."""

from .queries import comparisons, dna, panels, records, snapshots  # noqa: F401
from .queries.base import ORACLES, QUERIES  # noqa: F401
