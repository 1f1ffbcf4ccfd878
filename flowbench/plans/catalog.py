"""All registered queries. Importing this module fills the registry."""

from __future__ import annotations

from flowbench.plans import queries_compare, queries_models, queries_prepare, queries_streams, queries_tables  # noqa: F401
from flowbench.plans.queries_models import supplier_report as flagship
from flowbench.plans.registry import REGISTRY

__all__ = ["REGISTRY", "flagship"]
