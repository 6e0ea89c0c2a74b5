"""Composed plans: cleaned tables, credit tables, ad-hoc questions, the full run."""
