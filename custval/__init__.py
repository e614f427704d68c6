"""custval: customer-value analytics as Spark DataFrame jobs.

Order lines -> purchase-day hazard panel -> repeat curve -> expected orders;
order lines -> order-value cells -> empirical-Bayes fit -> expected order value;
both -> ranked per-customer value scores and their validation reports.
"""

from custval.params import Params

__all__ = ["Params"]
