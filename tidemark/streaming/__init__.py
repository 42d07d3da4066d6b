"""Structured streaming: feature batches into snapshot tables, windowed event counts."""
