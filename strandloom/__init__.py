"""strandloom: interval, structure and corpus analytics as plain PySpark DataFrame functions."""
