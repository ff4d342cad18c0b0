"""Log triage and training-data analytics on PySpark."""
