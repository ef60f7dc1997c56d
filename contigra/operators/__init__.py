"""Relational operators on the data model; one function an operator, named by its id in the docstring."""
