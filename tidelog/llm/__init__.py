"""Operators on training text; each module holds one, `queries` registers them."""
