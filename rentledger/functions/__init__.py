"""Column functions: scalars, money, dates and report formulas. All are built-in Spark expressions."""
