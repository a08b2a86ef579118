"""Relational building blocks shared by all reports."""
