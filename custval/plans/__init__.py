"""Jobs: hazard panel and curve (hazard), order-value model (aov), value scores (pltv)."""
