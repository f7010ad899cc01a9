"""A whole monitoring run, the history tables and the reports over them."""
