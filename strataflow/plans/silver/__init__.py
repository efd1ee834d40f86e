"""Cleaning and features of the five silver entities."""

from strataflow.plans.silver import belief, elicitation, movies, ratings, recommendations

__all__ = ["belief", "elicitation", "movies", "ratings", "recommendations"]
