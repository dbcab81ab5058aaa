"""Composed plans: the vendor run, the binding queries and their SQL oracle."""
