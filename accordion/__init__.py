"""Record reconciliation and data processing as DataFrame transformations."""
