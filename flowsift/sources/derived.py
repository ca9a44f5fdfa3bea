"""The derived flow views under their earlier name; they live in ``fixtures``."""

from flowsift.fixtures.views import VIEWS, stored_view

__all__ = ["VIEWS", "stored_view"]
