"""DataFrame operators that more than one plan uses."""
