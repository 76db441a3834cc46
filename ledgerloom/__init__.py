"""Batch reporting over ERP order, invoice, partner and product tables on Spark."""
