"""Import every query module so that the registry is complete."""
from shelfwise.plans import q_clean, q_eval, q_recommend, q_io, q_relational, q_text  # noqa: F401
from shelfwise.plans.registry import ORACLE, QUERIES  # noqa: F401
