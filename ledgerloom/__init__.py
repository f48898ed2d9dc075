"""Ledger-document analytics expressed as Spark DataFrame plans."""
