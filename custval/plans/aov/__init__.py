"""Phase 2: expected order value by empirical-Bayes shrinkage over log-scale cells."""
