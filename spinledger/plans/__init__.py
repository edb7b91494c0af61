"""Compositions of operators: layer refresh, named views, and the query catalogue."""
