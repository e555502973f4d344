"""Checks and operator plans; importing ``geoqa.plans.catalog`` registers them all."""
