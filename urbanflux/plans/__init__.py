"""Compositions of operators: serving views, dashboards' roll-ups, pipelines, queries."""
