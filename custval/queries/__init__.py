"""Registered queries, grouped by phase.  Importing this package registers them."""

from custval.queries import aov_q, extract_q, hazard_q, model_q, payload_q, pltv_q, sketch_q, validate_q  # noqa: F401
