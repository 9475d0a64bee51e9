"""Composed jobs, the model graph, registered queries and their SQL twins."""
