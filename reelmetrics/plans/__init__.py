"""Compositions of operators: gold refresh, serving queries, registered queries."""
