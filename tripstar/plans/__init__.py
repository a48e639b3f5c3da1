"""Analyses over the star, and the load jobs that keep its tables up to date."""
