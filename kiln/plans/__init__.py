"""Named queries over the supplied tables, one per operator key.

Importing this package registers every query module."""

from kiln.plans import ml_q, relational_q, search_q, tables_q, trees_q  # noqa: F401
from kiln.plans.registry import ORACLES, QUERIES  # noqa: F401
