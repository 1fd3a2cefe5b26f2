"""Importing this module registers every query."""

from terrafold.plans import q_cells, q_core, q_more, q_naming, q_products, q_stored  # noqa: F401
