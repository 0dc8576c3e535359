"""Evidence-backed fact analytics as composable Spark DataFrame and Column functions."""
