"""Food-delivery analytics on PySpark: typed staging, dimensions with history, order facts, KPI marts."""
