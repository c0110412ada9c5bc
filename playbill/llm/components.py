"""Connected components, as the other operators of the library use them."""

from __future__ import annotations

from playbill.operators.components import connected_components

__all__ = ["connected_components"]
