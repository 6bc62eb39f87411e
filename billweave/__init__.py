"""Billing-delivery engine on Spark: manifests, typed CSV parts, month tables, exports."""
