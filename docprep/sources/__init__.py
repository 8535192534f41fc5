"""Readers and model, OCR and page connectors. Each connector has an offline form that needs no network."""
