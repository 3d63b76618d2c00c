"""Schemas, readers, writers, catalog inventories and the shared work folder."""
