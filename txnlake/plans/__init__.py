"""Views and analytic queries over the gold tables."""
