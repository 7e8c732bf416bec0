"""Demand analytics on Spark: a day x hour x category cube, kept current and served."""
