"""Column-expression helpers; nothing here triggers a Spark action."""
