"""Configuration, schemas, the reconciliation run and the registered queries."""
