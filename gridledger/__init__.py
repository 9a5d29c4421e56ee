"""Season analytics for leagues, written as ordinary PySpark DataFrame code."""
