"""Stage functions and the registered queries."""
