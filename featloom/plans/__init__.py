"""Feature-set plans and the registered queries."""
