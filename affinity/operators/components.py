"""Connected components of an edge list (see ``affinity.llm.components``)."""

from ..llm.components import connected_components

__all__ = ["connected_components"]
