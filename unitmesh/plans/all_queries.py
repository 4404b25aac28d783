"""Import every query module so the registry is complete."""

from unitmesh.plans import q_cascade, q_merge, q_misc, q_registry, q_sites  # noqa: F401
from unitmesh.plans.registry import REGISTRY  # noqa: F401
