"""Interval, graph, structure and reporting operators (DataFrame in, DataFrame out)."""
