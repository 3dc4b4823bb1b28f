"""Declarative plans: filters, recipes, fusion."""
