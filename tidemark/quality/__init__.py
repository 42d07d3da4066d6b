"""Checks of data before it is saved, and a ledger of their results."""
