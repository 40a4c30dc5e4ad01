"""Composed jobs: the dataset build, model jobs, registered queries and their SQL twins."""
