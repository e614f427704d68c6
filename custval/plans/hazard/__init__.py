"""Phase 1: purchase-day repeat-purchase hazard panel, curve and projections."""
