"""Import every query module so the registry is complete."""

from pastline.plans import q_asof, q_chain, q_history, q_learn, q_metrics, q_prepare, q_profile, q_score  # noqa: F401
from pastline.plans.registry import REGISTRY  # noqa: F401
