"""Credit-risk data work as Spark DataFrame functions."""
