"""Plan helpers and registered queries."""
