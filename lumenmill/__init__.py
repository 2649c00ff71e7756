"""Text-corpus curation on PySpark: every operator is a DataFrame -> DataFrame function."""
