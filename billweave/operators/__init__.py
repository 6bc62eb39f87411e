"""DataFrame operators over manifests, column definitions, deliveries and billing tables."""
