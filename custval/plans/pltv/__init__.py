"""Combined value scores: expected orders x expected order value, and their reports."""
