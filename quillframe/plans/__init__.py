"""The catalogue's tables as views of the given tables, and the registered queries over them."""
