"""Bindings of the domain's tables to the generated ones, and the named queries over them."""
