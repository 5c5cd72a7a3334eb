"""Business plans built from the operators: eligibility, features, picking, training."""
