"""Column functions: text to typed values, credit formulas, quality flags."""
