"""DataFrame operators. Import them from their modules."""
