"""Readers: raw and typed event logs, the gold table, and the order-table adapter."""
