"""Query plans: dimensions, facts, analytic questions, the batch job."""
