"""Reusable DataFrame operators: cleaning steps, exact distributed rank / median."""
