"""Declarative plans: the conversion, the adapter over the star-schema tables, concept queries."""
